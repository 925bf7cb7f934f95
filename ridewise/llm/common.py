"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridewise.functions.lineage import cut_lineage

#: ASCII white space that separates words: space and \t \n \v \f \r, which is
#: also what ``bytes.split()`` splits on.
ARROW_ROWS, ARROW_BYTES = 500, "4m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts the lineage)."""
    return cut_lineage(df, f"llm-{label}")


def shuffled(df: DataFrame) -> DataFrame:
    """One side of a join between tables that grow with the corpus: dealt out by key at every size, never broadcast.

    Spark sizes an exploded or compressed table by its file, far under what a broadcast of it takes on the driver.
    """
    return df.hint("merge")


def small_arrow_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, by rows and by bytes, since a single text may be long.

    The session keeps the setting: results are lazy and read it when they run.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def utf8(c: str | Column) -> Column:
    """The UTF-8 bytes of a text; null counts as the empty text."""
    return F.encode(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), "UTF-8")


def id_fold(c: str | Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n`` (null id: null)."""
    return F.pmod(F.crc32(F.encode((F.col(c) if isinstance(c, str) else c).cast("string"), "UTF-8")), F.lit(n))


def runs(frames: Iterable[pd.DataFrame], key: str, limit: int) -> Iterator[tuple[pd.DataFrame, bool]]:
    """Cut frames whose rows are sorted by ``key`` into runs of one key.

    A run goes on over the frames' ends. One of more than ``limit`` rows comes
    in consecutive pieces of ``limit`` rows that share one row with the next,
    so memory is bounded; the flag says that a piece starts its run.
    """
    rest, first = None, True
    for frame in frames:
        if rest is not None:
            frame = pd.concat([rest, frame], ignore_index=True)
        if not len(frame):
            continue
        keys = frame[key].to_numpy()
        cuts = [0, *(i + 1 for i in (keys[1:] != keys[:-1]).nonzero()[0]), len(frame)]
        for a, b in zip(cuts[:-2], cuts[1:-1]):
            yield from _pieces(frame.iloc[a:b], first, limit)
            first = True
        a, b = cuts[-2], len(frame)
        while b - a > limit:
            yield frame.iloc[a:a + limit], first
            a, first = a + limit - 1, False
        rest = frame.iloc[a:b]
    if rest is not None and len(rest):
        yield from _pieces(rest, first, limit)


def _pieces(run: pd.DataFrame, first: bool, limit: int) -> Iterator[tuple[pd.DataFrame, bool]]:
    a = 0
    while len(run) - a > limit:
        yield run.iloc[a:a + limit], first
        a, first = a + limit - 1, False
    yield run.iloc[a:], first


def star_edges(ids: list, near: Callable[[int, list[int]], list[int]]) -> list[tuple]:
    """(smallest id, other id) for each component of the graph on 0..n-1.

    ``near(i, others)`` gives those of ``others`` that are linked with ``i``.
    Nodes that already hang together are never compared, so a group of copies
    costs one comparison a member.
    """
    edges, left = [], list(range(len(ids)))
    while left:
        queue = [left.pop(0)]
        members = list(queue)
        while queue and left:
            if hit := near(queue.pop(), left):
                queue += hit
                members += hit
                gone = set(hit)
                left = [j for j in left if j not in gone]
        if len(members) > 1:
            low = min(ids[i] for i in members)
            edges += [(low, ids[i]) for i in members if ids[i] != low]
    return edges


#: Edges of a graph that one task writes, when a round of components is stored.
EDGES_A_TASK = 250_000


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of an undirected graph given as rows (a, b).

    Alternates large-star and small-star rewriting (Kiveris et al., 2014)
    until every node points at the smallest node of its component. Each round
    is written to the shared folder. A component's smallest node is listed
    too. Self loops and repeated edges are harmless; no edges, no rows.
    """
    e = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
              .where("u != v").distinct(), "edges")
    state = None
    while True:
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or tuple(mark) == state:
            break
        state = tuple(mark)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(shuffled(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(shuffled(low), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        # tasks in proportion to the edges, not one for each shuffle partition
        e = stage(small.distinct().coalesce(1 + 2 * mark[0] // EDGES_A_TASK), "stars")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
