import pytest
from pyspark.sql import functions as F

#: Names that operators use inside or return; extra columns of these names must do no harm.
CLASHES = ["id", "key", "row", "size", "shard", "slot", "score", "kept", "spans", "n", "block", "grp", "tie", "epoch", "base", "rank", "n_words", "cluster", "s", "p", "m"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty and very long texts, repeated rows, ties, and clashing extra columns."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog today", "en", "a"), (2, None, "en", "a"), (3, "", None, "a"), (4, " \n\t ", "en", None),
        (5, "the quick brown fox jumps over the lazy dog today", "en", "b"), (5, "the quick brown fox jumps over the lazy dog today", "en", "b"),
        (None, "the quick brown fox jumps over the lazy dog today", "en", "b"), (None, None, None, None), (7, long, "de", "c"),
        (8, "a" * 50_000, "de", "c"), (9, "ÀÉ ß 日本 <|x|>   ²½", "fr", "c"), (10, "12345 !!!", "fr", "c"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs.withColumn("n_chars", F.length("text").cast("long")).withColumns({c: F.lit("x") for c in CLASHES})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
