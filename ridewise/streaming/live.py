"""Structured Streaming paths for the live predictor and the demand counter.

The reference scores requests one at a time on demand. Here the same column
expressions run on a stream of requests (stateless, append mode), and the
per-(city, hour) ride counter that feeds the demand features adds up partial
counts of micro-batches. Both write Parquet under the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridewise import config as C
from ridewise.operators import scoring as J
from ridewise.sources.schema import RIDE_SCHEMA


def read_ride_stream(spark: SparkSession, folder: str, max_files: int = 64) -> DataFrame:
    """Rides arriving as Parquet files in a folder (explicit schema, bounded batches)."""
    return (spark.readStream.schema(RIDE_SCHEMA).option("maxFilesPerTrigger", max_files)
                 .parquet(folder))


def valid_rides(rides: DataFrame) -> DataFrame:
    return rides.where(F.col("city").isin(C.VALID_CITIES))


def drain_volume(rides: DataFrame, path: str) -> DataFrame:
    """Count the rides of every available file per (city, hour); the counts so far.

    Each micro-batch writes its own partial counts to a folder named by its
    number, so a batch that is run again overwrites itself. Reading adds them
    up. Counts merge, so late rides need no watermark and no state, and a
    restarted query goes on from its checkpoint.
    """
    def store(batch: DataFrame, number: int) -> None:
        (batch.groupBy("city", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_start"))
              .agg(F.count(F.lit(1)).alias("rides"))
              .write.mode("overwrite").parquet(f"{path}/counts/batch={number}"))

    q = (rides.writeStream.foreachBatch(store).option("checkpointLocation", f"{path}/progress")
              .trigger(availableNow=True).start())
    q.awaitTermination()
    parts = rides.sparkSession.read.parquet(f"{path}/counts")
    return parts.groupBy("city", "hour_start").agg(F.sum("rides").alias("rides"))


def score_stream(requests: DataFrame, wait_model=None, surge_model=None, cancel_model=None) -> DataFrame:
    """Score a stream of scenario requests: model-free rule estimates plus the
    full prediction record (models optional)."""
    rules = J.rule_based_estimates(requests)
    return J.predict_all(rules, wait_model, surge_model, cancel_model)


def drain_rows(df: DataFrame, path: str) -> DataFrame:
    """Append the results for every available input to a Parquet sink; all so far.

    The sink's log and the checkpoint make a restarted query neither lose nor
    repeat a row.
    """
    q = (df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}/progress")
           .trigger(availableNow=True).start(f"{path}/rows"))
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
