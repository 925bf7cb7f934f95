"""The corpus pipeline, stage by stage, against plain versions of its decisions."""

import base64
import random
from collections import Counter

import pytest
import tiktoken
from pyspark.sql import functions as F
from test_groups import near_copies, plain_components
from test_texts import plain_spans

import corpus_pipeline
from ridewise.llm import common, op04_pairwise_quality, op08_minhash_forest
from ridewise.llm.catalog import BPE_PATTERN, BPE_VOCABULARY

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, function in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name))
        function(spark, docs, SF).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_columns(spark, results):
    columns = spark.read.parquet(f"{SF}/documents.parquet").dtypes
    assert all(r.dtypes == columns for r in results[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "minhash_near_dedup", "secret_scan", "temperature_mix", "byte_bpe"]


def test_quality_stage_drops_junk_and_keeps_the_rest(spark, results):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in results[0].select("doc_id").collect()}
    good, bad = ([d in kept for d, q in labels.items() if q == x] for x in (1, 0))
    assert sum(good) / len(good) > 0.95 and sum(bad) / len(bad) < 0.2


def test_dedup_stage_keeps_the_smallest_of_each_group(results):
    texts = {r.doc_id: r.text for r in results[0].collect()}
    want = {i for i, (_, c) in plain_components(texts, 5, 80).items() if i == c}
    assert sorted(r.doc_id for r in results[1].select("doc_id").collect()) == sorted(want)


def test_secret_stage_masks_and_keeps_rows(results):
    before, after = ({r.doc_id: r for r in results[i].collect()} for i in (1, 2))
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert not plain_spans(r.text)
        assert (r.text == before[i].text) == (not plain_spans(before[i].text))
        assert r.n_chars == len(r.text)


def test_mix_stage_levels_the_sources(results):
    once, mixed = Counter(r.doc_id for r in results[2].collect()), Counter(r.doc_id for r in results[3].collect())
    assert once.keys() == mixed.keys() and max(mixed.values()) <= 2
    words = {r.source: r.w for r in results[3].groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("w")).collect()}
    assert max(words.values()) / min(words.values()) < 2.1


def test_last_stage_is_the_tokenizer(results):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BPE_VOCABULARY, "rb"))}
    library = tiktoken.Encoding("own", pat_str=BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in results[3].collect()}
    rows = results[4].collect()
    assert len(rows) == results[3].count() and all(r.decodes for r in rows)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and bytes(r.token_ids) == b"".join(i.to_bytes(4, "little") for i in ids)


def test_odd_rows_go_through_every_stage(spark, odd_docs, no_docs, tmp_path):
    for docs, n in ((odd_docs, "odd"), (no_docs, "none")):
        for name, function in corpus_pipeline.STAGES:
            path = str(tmp_path / n / name)
            function(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
        assert (docs.count() > 0) == (n == "odd")


def test_repeated_rows_and_copies_leave_one(spark):
    draw = random.Random(9)
    rows = [(i, t) for i, t in enumerate(near_copies(draw, 6, 40, 0))] + [(0, None)] + [(50, "one two three four five six")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("x"))
    kept = corpus_pipeline.minhash_near_dedup(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in kept) == [0, 50] and docs.columns == ["doc_id", "text", "id"]


def test_no_join_that_grows_with_the_corpus_is_broadcast(spark, monkeypatch):
    """Spark sizes the exploded keys by their file, far under what a broadcast of them takes on the driver."""
    plans = {}

    def noted(real):
        def stage(df, label):
            plans[label] = df._jdf.queryExecution().executedPlan().toString()
            return real(df, label)
        return stage

    for module in (common, op04_pairwise_quality, op08_minhash_forest, corpus_pipeline):
        monkeypatch.setattr(module, "stage", noted(module.stage))
    draw = random.Random(9)
    docs = spark.createDataFrame(list(enumerate(near_copies(draw, 20, 120, 3))), "doc_id long, text string")
    plans["out"] = corpus_pipeline.minhash_near_dedup(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
    op04_pairwise_quality.fit(docs, docs.select("doc_id", (F.col("doc_id") % 2).alias("label")))
    assert {"regions", "edges", "stars", "clusters", "other", "training", "out"} <= plans.keys()
    assert [k for k, p in plans.items() if "BroadcastHashJoin" in p and k != "pairs"] == []
    # pairs: the first numbers of the buckets alone
    assert plans["pairs"].count("SortMergeJoin") == 1
