"""Near-duplicate documents by a MinHash LSH forest.

Every document's word shingles are hashed to a set of 64-bit fingerprints.
Equal sets form a class at once (an aggregate), and only one row a class, its
smallest doc_id, goes on. A MinHash signature of ``TREES * DEPTH`` values is
read in ``TREES`` orders (order t begins at value t * DEPTH). Sorting by an
order puts documents with a long common prefix next to each other. Candidates
are neighbours that share at least ``DEPTH`` leading values of some order; a
pair of similarity 0.8 is missed by all 24 orders with probability 3e-6.

Depth adapts to the region: a region (one prefix) of at most ``REGION`` rows
is searched whole; a denser one is sorted by the rest of its own order, so that
rows of a longer common prefix are neighbours, dealt over the cluster, and
searched in blocks of neighbours. Each tree goes on by values of its own, so
what one misses another may find. Every block hangs on its region's first row.

Candidates only say where to look. Candidate clusters of up to ``REGION``
documents are resolved on full sets in one task each; larger ones on full sets
in blocks of several signature orders. Whatever did not join its cluster's
largest component is then held against those rows of the cluster that share one
of its rarest shingles: so many of them that a linked row can't lack them all.
Where a shingle of those is common, against all rows, block by block. A task
gives its components as stars around their smallest id, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridewise.llm.common import connected_components, runs, shuffled, small_arrow_batches, stage, star_edges

TREES = 24
DEPTH = 4
REGION = 256
#: Orders in which a cluster of over REGION documents is cut into blocks.
BLOCK_ORDERS = 3
#: Estimated similarity from which neighbours are candidates; 5 standard
#: deviations under 0.8 for 96 values.
LOOSE = 0.58
#: A shingle in more rows of a cluster than this does not narrow a search.
RARE = 32
WORD_CACHE = 150_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_WORDS = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums of word hashes spread evenly."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct fingerprints of the k-word shingles of a text.

    A-Z are lower-cased; words are what ASCII white space separates. With
    fewer than k words the whole sequence is the one shingle; without words
    the set is empty.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if n < k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), n)] if n else [], dtype=np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=n)
    total = np.zeros(n - k + 1, dtype=np.uint64)
    for i in range(k):
        total = total * np.uint64(0xC2B2AE3D27D4EB4F) + h[i:n - k + 1 + i]
    return np.unique(_mixed(total))


@lru_cache(maxsize=4)
def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20)
    return (r.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            r.integers(0, 2**63, n, dtype=np.uint64))


def signature(shingles: np.ndarray, n: int = TREES * DEPTH) -> np.ndarray:
    """The n MinHash values (32 bits each) of a set that is not empty."""
    a, b = _permutations(n)
    low = np.full(n, 2**64 - 1, dtype=np.uint64)
    for i in range(0, len(shingles), 4096):
        x = shingles[None, i:i + 4096]
        np.minimum(low, (x * a[:, None] + b[:, None]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def _tree_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key a tree: the tree's number and its first DEPTH values."""
    key = np.arange(1, TREES + 1, dtype=np.uint64)
    for column in sig.reshape(TREES, DEPTH).T:
        key = _mixed(key * np.uint64(0xC2B2AE3D27D4EB4F) + column.astype(np.uint64))
    return key.view(np.int64)


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, n_shingles, digest, keys, sig) of every row; one pass over the texts."""

    def per_batch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for doc_id, text in zip(f["doc_id"], f["text"]):
                s = shingle_set(text, shingle)
                if len(s):
                    sig = signature(s)
                    out.append((doc_id, len(s), xxhash.xxh3_128_digest(s.tobytes()), _tree_keys(sig), sig.astype(np.uint8).tobytes()))
                else:
                    out.append((doc_id, 0, None, None, None))
            g = pd.DataFrame(out, columns=["doc_id", "n_shingles", "digest", "keys", "sig"])
            # ids come as text, so that a null beside them makes no float of them
            g["doc_id"] = pd.array([None if x is None else int(x) for x in g["doc_id"]], dtype="Int64")
            yield g

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(
        per_batch, "doc_id long, n_shingles long, digest binary, keys array<long>, sig binary")


def _loose_edges(frames: Iterator[pd.DataFrame], hangs: bool = False) -> Iterator[pd.DataFrame]:
    """Components at estimated similarity >= LOOSE of each region, or block of one, as stars.

    hangs: link each block's first row with the region's first.
    """
    need = (LOOSE + (1 - LOOSE) / 256) * TREES * DEPTH
    a, b = [], []
    for run, _ in runs(frames, "key", REGION):
        ids = run["id"].to_numpy()
        sigs = np.frombuffer(b"".join(run["sig"]), dtype=np.uint8).reshape(len(run), -1)
        for x, y in star_edges(ids, lambda i, o: [o[x] for x in ((sigs[o] == sigs[i]).sum(axis=1) >= need).nonzero()[0]]):
            a.append(x)
            b.append(y)
        if hangs:
            a.append(run["leader"].iloc[0])
            b.append(ids[0])
        if len(a) > 20_000:
            yield pd.DataFrame({"a": a, "b": b})
            a, b = [], []
    yield pd.DataFrame({"a": a, "b": b}, dtype="int64")


def _linked(sets: list[np.ndarray], percent: int):
    """near() on full sets: 100 * |x & y| >= percent * |x | y|."""
    sizes = np.array([len(s) for s in sets])

    def near(i: int, others: list[int]) -> list[int]:
        o = np.array(others)
        lo, hi = np.minimum(sizes[o], sizes[i]), np.maximum(sizes[o], sizes[i])
        found = []
        for j in o[100 * lo >= percent * hi]:
            both = np.intersect1d(sets[i], sets[j], assume_unique=True).size
            if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                found.append(int(j))
        return found
    return near


def _exact_edges(shingle: int, percent: int, limit: int):
    """The components on full sets of each run of one ``grp``, as stars."""
    def per_part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run, _ in runs(frames, "grp", limit):
            if len(run) < 2:
                continue
            ids = run["id"].to_numpy()
            sets = [shingle_set(t, shingle) for t in run["text"]]
            if e := star_edges(ids, _linked(sets, percent)):
                yield pd.DataFrame(e, columns=["a", "b"])
    return per_part


def _rest_edges(shingle: int, percent: int):
    """Links of the rows with ``rest`` to the others of their ``grp``, one a component."""
    def per_part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run, _ in runs(frames, "grp", 8 * REGION):
            rest, ids, comp = run["rest"].to_numpy(), run["id"].to_numpy(), run["component"].to_numpy()
            sets = [shingle_set(t, shingle) for t in run["text"]]
            near = _linked(sets, percent)
            members = (~rest).nonzero()[0]
            a, b = [], []
            for i in rest.nonzero()[0]:
                seen = {comp[i]}
                others = [int(j) for j in members if comp[j] != comp[i]]
                for j in near(int(i), others) if others else []:
                    if comp[j] not in seen:
                        seen.add(comp[j])
                        a.append(ids[i])
                        b.append(ids[j])
            if a:
                yield pd.DataFrame({"a": a, "b": b})
    return per_part


def _shingles(shingle: int):
    """The rows with their shingles in place of the text."""
    def per_part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            sets = [shingle_set(t, shingle).view(np.int64) for t in f["text"]]
            yield f.drop(columns="text").assign(n=[len(s) for s in sets], xs=sets)
    return per_part


def _sorted_parts(df: DataFrame, key: str, *order: str) -> DataFrame:
    return df.repartition(key).sortWithinPartitions(key, *order)


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``.

    Takes columns doc_id and text; others are ignored. Documents are linked
    when 100 * |intersection| >= percent * |union| of their shingle sets;
    component_id is the smallest doc_id reachable. Texts that are null, empty
    or without a word are linked with nothing. Rows that share a doc_id count
    as one document. A null doc_id gets a null component_id, is not kept and
    takes part in nothing. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_arrow_batches(spark)
    feats = stage(fingerprints(docs, shingle), "fingerprints")
    real = feats.where("digest is not null and doc_id is not null")
    reps = stage(real.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("keys").alias("keys"), F.first("sig").alias("sig")), "classes")

    entries = reps.select("id", F.posexplode("keys").alias("tree", "key"))
    dense = entries.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("leader")).where("n > 1")
    regions = stage(entries.join(shuffled(dense), "key"), "regions")
    sigs = reps.select("id", "sig").join(shuffled(regions.select("id").distinct()), "id", "left_semi")
    rows = regions.join(shuffled(sigs), "id")
    parts = _sorted_parts(rows.where(F.col("n") <= REGION), "key")
    edges = parts.select("key", "id", "leader", "sig").mapInPandas(_loose_edges, "a long, b long")
    if regions.where(F.col("n") > REGION).limit(1).count():
        # a region goes on by the values that follow its prefix in its tree's order
        n = TREES * DEPTH
        order = F.concat(F.substring("sig", F.col("tree") * DEPTH + 1, F.lit(n)), F.substring("sig", F.lit(1), F.col("tree") * DEPTH))
        hot = rows.where(F.col("n") > REGION).withColumn("order", order)
        hot = hot.repartitionByRange(_shuffles(spark), "key", "order", "id").sortWithinPartitions("key", "order", "id")
        hot = hot.select("key", "id", "leader", "sig").mapInPandas(lambda frames: _loose_edges(frames, hangs=True), "a long, b long")
        edges = edges.unionByName(hot)

    clusters = connected_components(edges).withColumnsRenamed({"node": "id", "component": "cluster"})
    sized = clusters.join(shuffled(clusters.groupBy("cluster").agg(F.count("*").alias("size"))), "cluster")
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    found = (texts.join(shuffled(sized), "id").groupBy("id", "cluster", "size", F.xxhash64("text").alias("th"))
             .agg(F.first("text").alias("text")))
    found = stage(found, "clusters")
    small = _sorted_parts(found.where(F.col("size") <= REGION).select(F.col("cluster").alias("grp"), "id", "text"), "grp", "id")
    links = small.mapInPandas(_exact_edges(shingle, percent, 8 * REGION), "a long, b long")
    large = found.where(F.col("size") > REGION)
    if large.limit(1).count():
        links = stage(links.unionByName(_large_links(large, sigs, shingle, percent)), "links")
    comps = connected_components(links)

    classes = reps.select("digest", "id").join(shuffled(comps.withColumnRenamed("node", "id")), "id", "left").select(
        "digest", F.coalesce("component", "id").alias("component"))
    # rows that share a doc_id but not a text are one document
    top = real.select("doc_id", "digest").join(shuffled(classes), "digest").groupBy("doc_id").agg(F.min("component").alias("component"))
    return feats.select("doc_id", "n_shingles").join(shuffled(top), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(False)).alias("kept"))


def _shuffles(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _large_links(large: DataFrame, sigs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links within clusters of over REGION documents, on full sets."""
    spark = large.sparkSession
    turned = large.join(shuffled(sigs), "id")
    n = TREES * DEPTH
    orders = F.array(*(F.concat(F.substring("sig", i + 1, n), F.substring("sig", 1, i)) for i in range(0, n, n // BLOCK_ORDERS)))
    dealt = (turned.select("cluster", "id", "text", F.posexplode(orders).alias("turn", "order"))
             .select(F.xxhash64("cluster", "turn").alias("grp"), "order", "id", "text")
             .repartitionByRange(_shuffles(spark), "grp", "order", "id").sortWithinPartitions("grp", "order", "id"))
    links = stage(dealt.select("grp", "id", "text").mapInPandas(_exact_edges(shingle, percent, REGION), "a long, b long"), "block-links")
    comps = connected_components(links)
    state = (large.join(shuffled(comps.withColumnRenamed("node", "id")), "id", "left")
             .withColumn("component", F.coalesce("component", "id")))
    size = state.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    main = size.groupBy("cluster").agg(F.max(F.struct("n", "component")).alias("m"), F.sum("n").alias("total"))
    state = stage(state.join(main.select("cluster", F.col("m.component").alias("main"), "total"), "cluster")
                  .withColumn("rest", F.col("component") != F.col("main")).drop("main"), "blocks")
    if not state.where("rest").limit(1).count():
        return links
    pairs, broad = _partners(state, shingle, percent)
    unit, keys = ["cluster", "id", "th"], ["id", "component", "text"]
    own = F.xxhash64(F.lit("unit"), *unit).alias("grp")
    met = pairs.select(*unit).distinct().join(shuffled(state), unit).select(own, *keys, F.lit(True).alias("rest"))
    other = pairs.select(own, "cluster", F.col("to_id").alias("id"), F.col("to_th").alias("th")).join(shuffled(state), unit)
    met = met.unionByName(other.select("grp", *keys, F.lit(False).alias("rest")))
    if broad.limit(1).count():
        rest = state.join(shuffled(broad), unit, "left_semi")
        chunks = rest.groupBy("cluster").agg(F.count("*").alias("n")).select("cluster", F.ceil(F.col("n") / REGION).cast("int").alias("chunks"))
        blocks = F.ceil(F.col("total") / REGION).cast("int")
        spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        # both sides hash the same types
        grp = F.xxhash64("cluster", F.col("chunk").cast("long"), F.col("block").cast("long")).alias("grp")
        a = rest.join(chunks, "cluster").select("cluster", *keys, F.pmod(F.xxhash64("id", "text"), "chunks").alias("chunk"), spread(blocks).alias("block"))
        b = state.join(chunks, "cluster").select("cluster", *keys, spread(F.col("chunks")).alias("chunk"), F.pmod(F.xxhash64("id", "text"), blocks).alias("block"))
        met = met.unionByName(a.select(grp, *keys, F.lit(True).alias("rest"))).unionByName(b.select(grp, *keys, F.lit(False).alias("rest")))
    more = _sorted_parts(met, "grp", "rest", "id").mapInPandas(_rest_edges(shingle, percent), "a long, b long")
    return links.unionByName(more)


def _partners(state: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Where the links of the rows with ``rest`` can be: (cluster, id, th, to_id, to_th), and (cluster, id, th) of those to hold against all.

    A row linked with one of n shingles has all but n - ceil(n * percent / 100)
    of them, so it has one of any more; taken are those that are in the fewest
    rest rows. Rows with one that over RARE rows have, and rows of over REGION
    partners, are left to the caller.
    """
    unit = ["cluster", "id", "th"]
    touched = state.join(state.where("rest").select("cluster").distinct(), "cluster", "left_semi")
    sets = stage(touched.select(*unit, "component", "rest", "text").mapInPandas(
        _shingles(shingle), "cluster long, id long, th long, component long, rest boolean, n long, xs array<long>"), "shingles")
    each = sets.select(*unit, "component", "rest", "n", F.explode("xs").alias("x"))
    often = each.where("rest").groupBy("cluster", "x").agg(F.count("*").alias("f"))
    rank = F.row_number().over(Window.partitionBy(*unit).orderBy("f", "x"))
    first = each.where("rest").join(shuffled(often), ["cluster", "x"]).withColumn("r", rank)
    first = stage(first.where(F.col("r") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).select(*unit, "component", "n", "x"), "rarest")
    having = stage(each.join(shuffled(first.select("cluster", "x").distinct()), ["cluster", "x"], "left_semi"), "having")
    wide = having.groupBy("cluster", "x").agg(F.count("*").alias("rows")).where(F.col("rows") > RARE).select("cluster", "x")
    wide = stage(wide, "wide")
    to = having.select("cluster", "x", F.col("id").alias("to_id"), F.col("th").alias("to_th"), F.col("component").alias("to_component"),
                       F.col("rest").alias("to_rest"), F.col("n").alias("to_n"))
    fits = 100 * F.least("n", "to_n") >= percent * F.greatest("n", "to_n")
    # of two rest rows the one of the smaller id looks for the other
    once = ~F.col("to_rest") | (F.col("id") < F.col("to_id"))
    pairs = first.join(shuffled(wide), ["cluster", "x"], "left_anti").join(shuffled(to), ["cluster", "x"]).where((F.col("component") != F.col("to_component")) & fits & once)
    pairs = stage(pairs.select(*unit, "to_id", "to_th").distinct(), "partners")
    many = pairs.groupBy(*unit).agg(F.count("*").alias("n")).where(F.col("n") > REGION).select(*unit)
    broad = stage(first.join(shuffled(wide), ["cluster", "x"], "left_semi").select(*unit).unionByName(many).distinct(), "broad")
    return pairs.join(shuffled(broad), unit, "left_anti"), broad
