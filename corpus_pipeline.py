"""From raw documents to encoded training text, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next one's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridewise.llm import op02_temperature_mix, op03_secret_scan, op04_pairwise_quality, op07_byte_bpe, op08_minhash_forest
from ridewise.llm.catalog import BPE_PATTERN, BPE_VOCABULARY, MIX_SEED, SCAN_VOCABULARY, training_labels
from ridewise.llm.common import shuffled, small_arrow_batches, stage, table

#: Words a shingle of the near-duplicate stage.
SHINGLE = 5


def _unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*(F.col(f"row.`{c}`").alias(c) for c in columns))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality ranking rejects (score under 0.3)."""
    ranking = op04_pairwise_quality.fit(docs, training_labels(spark, sf_dir))
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    return _unpacked(op04_pairwise_quality.scored(rows, ranking, F.col("row.text")).where("predicted = 1"), docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, the one of smallest doc_id.

    Rows that share a doc_id are one document: one of them stays. Rows without
    a doc_id can't be told apart by it and all stay.
    """
    found = op08_minhash_forest.near_duplicates(docs, shingle=SHINGLE, percent=80).where("doc_id is not null")
    # the ids that go, and those of several rows, are fewer than the ids that stay
    found = found.groupBy(F.col("doc_id").alias("id")).agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
    other = stage(found.where("not kept or rows > 1"), "other")
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    same = F.col("row.doc_id") == F.col("id")
    once = rows.join(shuffled(other), same, "left_anti")
    repeated = rows.join(shuffled(other.where("kept")), same).groupBy("id").agg(F.min_by("row", F.coalesce("row.text", F.lit(""))).alias("row"))
    return _unpacked(once.unionByName(repeated.select("row")), docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret in the texts; no document goes."""
    return op03_secret_scan.mask_documents(docs, SCAN_VOCABULARY, BPE_PATTERN)


def temperature_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed stream: every document at least once, those of small sources again, in block order."""
    columns = op02_temperature_mix.mix_columns(MIX_SEED)
    plan = op02_temperature_mix.mixing_plan(stage(docs.select(*(c.alias(n) for n, c in columns.items())), "mix-rows"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), *(c.alias(n) for n, c in columns.items()))
    dealt = op02_temperature_mix.mixed(rows, plan).select("row", "block", "key")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _unpacked(dealt.repartitionByRange(parts, "block", "key").sortWithinPartitions("block", "key"), docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes the texts: doc_id, source, n_tokens, token_ids (little-endian, unsigned, 32 bits), and whether decoding gives the text back."""
    small_arrow_batches(spark)
    rows = docs.select("doc_id", "source", op07_byte_bpe.round_trip(F.col("text").cast("string"), BPE_VOCABULARY, BPE_PATTERN).alias("r"))
    return rows.select("doc_id", "source", (F.octet_length("r.token_ids") / 4).cast("long").alias("n_tokens"), "r.token_ids", "r.decodes")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("secret_scan", secret_scan),
    ("temperature_mix", temperature_mix),
    ("byte_bpe", byte_bpe),
]

#: The fit, the dedup and the tokenizer have no SQL; a test runs a plain version beside them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
