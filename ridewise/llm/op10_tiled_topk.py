"""Exact top-k search by inner product, in tiles.

Vectors are packed into blocks, one binary row each; queries into blocks of
``QUERY_BLOCK``, candidates into blocks of about ``BLOCK``. A tile is a query
block against a candidate block: one matrix product and a partial selection
of each query's k best. The tiles' short lists are merged as a tree of
``FAN_IN`` lists a node, so no task ever holds all lists of a query.

Scores are integers and exact: products run in floating point only where every
sum stays below 2**53, in 64-bit integers below 2**63, else in Python integers,
for the rows alone that need them. Lists are ordered by the exact scores, also
where the score given is the nearest 64-bit integer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridewise.llm.common import stage

BLOCK = 4096
QUERY_BLOCK = 2048
FAN_IN = 32
LONG = 2 ** 63 - 1


def usable(vector: Column) -> Column:
    """No null and no non-finite component."""
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(math.inf), F.lit(False)))


def quantised(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, as 64-bit integers or, where one leaves them, Python integers."""
    with np.errstate(over="ignore"):
        v = np.floor(x * scale)
    if (np.abs(v) < 2.0 ** 63).all():
        return v.astype(np.int64)
    # a product that overflows is that of a whole number
    whole = [int(a) if math.isfinite(a) else int(b) * scale for a, b in zip(v.ravel().tolist(), x.ravel().tolist())]
    return np.array(whole, dtype=object).reshape(x.shape)


def _packed(frames: pd.DataFrame) -> pd.DataFrame:
    """A block of vectors as one row; ids and row numbers beside them."""
    return pd.DataFrame({"dim": [frames["dim"].iloc[0]], "block": [frames["block"].iloc[0]], "none": [frames["none"].to_numpy(dtype=bool).tobytes()],
                         "ids": [frames["id"].to_numpy(dtype=np.int64).tobytes()], "rows": [frames["row"].to_numpy(dtype=np.int64).tobytes()],
                         "data": [np.stack(frames["v"].to_list()).astype(np.float64).tobytes() if frames["dim"].iloc[0] else b""]})


_PACKED = "dim int, block int, none binary, ids binary, rows binary, data binary"


def _largest(v: np.ndarray) -> int:
    return int(np.abs(v).max(initial=0))


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    top = _largest(q) * _largest(c) * max(1, q.shape[1])
    if top < 2 ** 63 and q.dtype != object and c.dtype != object:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64) if top < 2 ** 53 else q @ c.T
    # rows under this are safe with each other
    least = math.isqrt((2 ** 63 - 1) // max(1, q.shape[1]))
    fine_q, fine_c = ((np.abs(v) < least).all(axis=1).astype(bool) for v in (q, c))
    out = np.empty((len(q), len(c)), dtype=object)
    out[np.ix_(fine_q, fine_c)] = q[fine_q].astype(np.int64) @ c[fine_c].astype(np.int64).T
    out[~fine_q] = q[~fine_q].astype(object) @ c.astype(object).T
    out[np.ix_(fine_q, ~fine_c)] = q[fine_q].astype(object) @ c[~fine_c].astype(object).T
    return out


def _beyond(score: int) -> bytes | None:
    """Bytes that sort like the scores that are saturated to one 64-bit integer."""
    if -LONG - 1 < score < LONG:
        return None
    size = (abs(score).bit_length() + 7) // 8
    key = size.to_bytes(4, "big") + abs(score).to_bytes(size, "big")
    return key if score > 0 else bytes(255 - b for b in key)


def _tiles(k: int, scale: int):
    def per_part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for t in frame.itertuples(index=False):
                qid, qrow = np.frombuffer(t.q_ids, np.int64), np.frombuffer(t.q_rows, np.int64)
                cid, crow, none = np.frombuffer(t.ids, np.int64), np.frombuffer(t.rows, np.int64), np.frombuffer(t.none, bool)
                c = quantised(np.frombuffer(t.data, np.float64).reshape(len(cid), t.dim), scale)
                q = quantised(np.frombuffer(t.q_data, np.float64).reshape(len(qid), t.dim), scale)
                out = []
                for a in range(0, len(qid), 256):  # bounds the tile's scores
                    scores = _scores(q[a:a + 256], c)
                    for i, line in enumerate(scores, a):
                        ok = (crow != qrow[i]).nonzero()[0]
                        s = line[ok]
                        if len(ok) > k:
                            least = np.partition(s, len(s) - k)[len(s) - k]
                            enough = (s >= least).astype(bool)
                            ok, s = ok[enough], s[enough]
                        if s.dtype == object:      # places instead of what lexsort can't sort
                            place = {x: n for n, x in enumerate(sorted(set(s), reverse=True))}
                            down = np.array([place[x] for x in s], dtype=np.int64)
                        else:
                            down = -s
                        best = np.lexsort((crow[ok], cid[ok], none[ok], down))[:k]
                        out += [(qid[i], qrow[i], cid[ok[j]], crow[ok[j]], min(max(int(s[j]), -LONG - 1), LONG), _beyond(int(s[j])), t.block, none[ok[j]]) for j in best]
                f = pd.DataFrame(out, columns=["query_id", "query_row", "vec_id", "vec_row", "score", "beyond", "node", "none"])
                yield f.assign(vec_id=f["vec_id"].astype("Int64").mask(f.pop("none").astype(bool)))
    return per_part


def top_k(vectors: DataFrame, is_query: Column, k: int, scale: int = 256, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k best other rows.

    Takes vec_id and embedding; others are ignored. Ties go to the smaller
    vec_id, null ids last, then to an arbitrary one of rows with equal ids.
    Vectors that are null or hold a null or non-finite component take no part. Only vectors of one length are compared. A repeated row is a
    candidate of its copies, not of itself. With fewer than k other rows all
    are given; an empty table gives no rows. Scores beyond 64 bits saturate,
    ranks follow the exact ones.
    """
    rows = vectors.select("vec_id", "embedding", is_query.alias("is_query")).where(usable(F.col("embedding")))
    rows = stage(rows.select(F.coalesce("vec_id", F.lit(0)).alias("id"), F.col("vec_id").isNull().alias("none"), F.coalesce("is_query", F.lit(False)).alias("is_query"), F.col("embedding").cast("array<double>").alias("v"),
                             F.size("embedding").alias("dim"), F.monotonically_increasing_id().alias("row")), "vectors")
    n = rows.agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).first()
    shards, lanes = max(1, math.ceil(n["n"] / block)), max(1, math.ceil(n["q"] / QUERY_BLOCK))

    def blocks(part: DataFrame, count: int) -> DataFrame:
        dealt = part.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(count)).cast("int"))
        return stage(dealt.groupBy("dim", "block").applyInPandas(_packed, _PACKED), "blocks")

    cands, queries = blocks(rows, shards), blocks(rows.where("is_query"), lanes)
    asked = queries.select("dim", F.col("block").alias("lane"), F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.col("data").alias("q_data"),
                           F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("block"))
    cells = cands.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))).join(asked.hint("merge"), ["dim", "lane", "block"])
    lists = cells.select("dim", "ids", "rows", "none", "data", "q_ids", "q_rows", "q_data", "block").mapInPandas(
        _tiles(k, scale), "query_id long, query_row long, vec_id long, vec_row long, score long, beyond binary, node int")
    while True:
        lists = lists.withColumn("node", F.floor(F.col("node") / FAN_IN).cast("int"))
        best = Window.partitionBy("query_row", "node").orderBy(F.desc("score"), F.desc("beyond"), F.asc_nulls_last("vec_id"), "vec_row")
        lists = lists.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        shards = math.ceil(shards / FAN_IN)
        if shards == 1:
            return lists.select("query_id", "rank", "vec_id", "score")
        lists = lists.drop("rank")
