import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ridewise.llm import op01_kd_shards, op02_temperature_mix
from ridewise.llm.catalog import REGISTRY
from ridewise.llm.weighted_cut import weighted_cuts

SF = "/root/testdata/sf0.01"


def test_shards_of_documents(spark):
    rows = REGISTRY["op1_kd_shards"][0](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    size, slots = Counter(), defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert sorted(size) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # a split misses by half a document at most, four or five splits a leaf
    assert max(size.values()) - min(size.values()) <= max(r["size"] for r in rows)


def test_leaves_reach_target_bytes(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("abcd").alias("text"), F.lit("en").alias("lang"), F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("source"))
    got = Counter(r.shard for r in op01_kd_shards.kd_shards(docs, target_bytes=4000).select("shard").collect())
    assert len(got) == 12 and max(got.values()) - min(got.values()) <= 2


def test_identical_rows_are_split(spark):
    docs = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"), F.lit("en").alias("lang"), F.lit("a").alias("source"))
    got = Counter(r.shard for r in op01_kd_shards.kd_shards(docs, n_shards=5).select("shard").collect())
    assert len(got) == 5 and max(got.values()) - min(got.values()) <= 2


def test_ranks_of_values(spark):
    names = [f"https://example.com/{i * 7919 % 500:04d}/é" for i in range(500)] + ["", "https:/", "Z", "日本"]
    docs = spark.createDataFrame([(n,) for n in names * 2 + [None]], "source string").repartition(7)
    got = {r.source: r["rank"] for r in op01_kd_shards.value_ranks(docs, "source").collect()}
    assert got == {n: i for i, n in enumerate(sorted(set(names), key=str.encode), 1)}
    assert op01_kd_shards.value_ranks(docs.limit(0), "source").count() == 0


def test_long_names_with_one_beginning_are_told_apart(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"), F.lit("en").alias("lang"),
                                    F.concat(F.lit("https://"), F.when(F.col("id") % 2 == 0, "a").otherwise("b"), F.lit(".example.com")).alias("source"))
    rows = op01_kd_shards.kd_shards(docs, n_shards=2).collect()
    assert {(r.doc_id % 2, r.shard) for r in rows} == {(0, 0), (1, 1)}


def test_shards_of_odd_and_no_rows(odd_docs, no_docs):
    rows = op01_kd_shards.kd_shards(odd_docs, n_shards=24).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.shard < 24 and r.slot >= 0 for r in rows)
    assert {r["size"] for r in rows if r.doc_id == 2} == {8}
    assert op01_kd_shards.kd_shards(no_docs, n_shards=24).count() == 0


@pytest.mark.parametrize("same", [False, True])
def test_weighted_cut_is_a_weighted_quantile(spark, same):
    values = [((i * 7919) % 101 if not same else 5, i * 31, 1 + i % 7) for i in range(1000)]
    rows = spark.createDataFrame([(1, *v) for v in values], "grp int, k1 long, k2 long, w long")
    total = sum(v[2] for v in values)
    cut = weighted_cuts(rows, spark.createDataFrame([(1, 0.3 * total)], "grp int, target double"), 0.0).first()
    left = sum(w for a, b, w in values if (a, b) <= (cut.c1, cut.c2))
    assert abs(left - 0.3 * total) <= 7


def mix_rows(spark, sizes):
    docs = spark.createDataFrame([(i, " ".join(["w"] * 10), s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))], "doc_id long, text string, source string")
    return docs.select("doc_id", "source", *(c.alias(n) for n, c in op02_temperature_mix.mix_columns(1).items())).cache()


def test_repetition_limit(spark):
    rows = mix_rows(spark, {"a": 4000, "b": 1000, "c": 500})
    plan = op02_temperature_mix.mixing_plan(rows, max_epochs=2.0)
    got = op02_temperature_mix.mixed(rows, plan).collect()
    docs = Counter(r.source for r in got)
    # a once, c twice, b between: alpha = 1 - ln 2 / ln 8
    assert abs(plan.alpha - (1 - 1 / 3)) < 1e-4
    assert docs["a"] == 4000 and docs["c"] == 1000 and abs(docs["b"] - 1000 * 4 ** (1 / 3)) <= 1
    assert len({r.doc_id for r in got}) == 5500
    assert max(Counter((r.doc_id, r.epoch) for r in got).values()) == 1
    # every block holds every source near its weight
    blocks = defaultdict(Counter)
    for r in got:
        blocks[r.block][r.source] += 1
    assert len(blocks) == op02_temperature_mix.BLOCKS
    assert all(abs(b["a"] / sum(b.values()) - docs["a"] / len(got)) < 0.15 for b in blocks.values())


def test_entropy_target_and_budget(spark):
    import math

    rows = mix_rows(spark, {"a": 3000, "b": 600, "c": 300})
    plan = op02_temperature_mix.mixing_plan(rows, max_epochs=None, entropy=0.9, budget=20_000)
    weights = [r.weight for r in plan.sources.collect()]
    assert abs(-sum(w * math.log(w) for w in weights) / math.log(3) - 0.9) < 1e-4
    got = op02_temperature_mix.mixed(rows, plan)
    tokens = {r.source: r.t for r in got.groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}
    want = {r.grp[1:]: r.weight * 20_000 for r in plan.sources.collect()}
    assert all(abs(tokens[s] - want[s]) <= 10 for s in want)


def plain_budgets(sizes, max_epochs):
    """Epochs of each source, from token sums, by bisection of alpha in plain floats."""
    lo, hi = 0.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        rate = [t ** (mid - 1) for t in sizes.values()]
        lo, hi = (lo, mid) if max(rate) / min(rate) <= max_epochs else (mid, hi)
    least = min(t ** (hi - 1) for t in sizes.values())
    return {s: t ** (hi - 1) / least for s, t in sizes.items()}


def test_mix_query_against_a_plain_mix(spark):
    got = REGISTRY["op2_temperature_mix"][0](spark, SF).collect()
    size = {r.doc_id: -(-len((r.text or "").encode()) * 2 // 5) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    source = {r.doc_id: r.source for r in got}
    sums = Counter()
    for d, n in size.items():
        sums[source[d]] += n
    taken = Counter()
    for r in got:
        assert r.n_tokens == size[r.doc_id]
        taken[r.source] += r.n_tokens
    most = Counter()
    for d, n in size.items():
        most[source[d]] = max(most[source[d]], n)
    # a budget is missed by a part of one document at most
    for s, epochs in plain_budgets(sums, op02_temperature_mix.MAX_EPOCHS).items():
        assert abs(taken[s] - epochs * sums[s]) <= most[s] + 1e-3 * sums[s]


def test_scripts_without_spaces_weigh_by_their_tokens(spark):
    rows = [(i, "日本語のテキストを書く" * 20, "ja") for i in range(200)] + [(1000 + i, "a short line of words " * 10, "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").select("doc_id", *(c.alias(n) for n, c in op02_temperature_mix.mix_columns(1).items()))
    tokens = {r.grp: r.t for r in docs.groupBy("grp").agg(F.sum("n_tokens").alias("t")).collect()}
    assert tokens["=ja"] == 200 * 264 and tokens["=en"] == 200 * 88


def test_mix_query_keeps_every_document(spark):
    rows = REGISTRY["op2_temperature_mix"][0](spark, SF)
    ids = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
    assert ids.join(rows, "doc_id", "left_anti").count() == 0
    tokens = [r.t for r in rows.groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()]
    assert max(tokens) / min(tokens) < 1.1


def test_mix_of_odd_and_no_rows(odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        rows = docs.select("doc_id", *(c.alias(n) for n, c in op02_temperature_mix.mix_columns(1).items()))
        got = op02_temperature_mix.mixed(rows, op02_temperature_mix.mixing_plan(rows))
        assert got.where("epoch = 0").count() == docs.count()
