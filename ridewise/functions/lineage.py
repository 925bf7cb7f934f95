"""Cut a plan's lineage by writing it to the shared checkpoint folder.

Used where one expensive intermediate (e.g. the deduplicated rides) feeds
several aggregates and a final projection: without it every consumer would
repeat the shuffle that produced it. The Parquet copy is re-read with column
pruning, so the aggregates scan only the columns they need, and a lost
executor re-reads files instead of recomputing the shuffle.

Copies are named by application; ``discard`` removes one that nothing reads any
more, ``session.clear_work`` all of an application's.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ridewise.session import checkpoint_dir, delete_folder


#: Bytes of stored files that one task of a write reads: its rows are sorted in memory, not on disk.
SPLIT_BYTES = 32 << 20
#: Files a task holds open, one a partition value, before it sorts its rows by that value.
OPEN_FILES = 16
_SETTINGS = threading.RLock()     # settings belong to the session, so one write at a time changes them


@contextmanager
def bounded_tasks(spark: SparkSession) -> Iterator[None]:
    """While a table is written, tasks read at most SPLIT_BYTES and write each partition value's file unsorted.

    The default split grows with the table to 128 MB, whose rows do not fit a
    task's memory when they are sorted.
    """
    name, writers = "spark.sql.files.maxPartitionBytes", "spark.sql.maxConcurrentOutputFileWriters"
    with _SETTINGS:
        before = {c: spark.conf.get(c) for c in (name, writers)}
        spark.conf.set(name, str(SPLIT_BYTES))
        spark.conf.set(writers, str(OPEN_FILES))
        try:
            yield
        finally:
            for c, v in before.items():
                spark.conf.set(c, v)


def store(df: DataFrame, label: str = "work") -> tuple[DataFrame, str]:
    """A stored copy of ``df``, and its folder."""
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{checkpoint_dir(spark).rstrip('/')}/ridewise/work/{app}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).select(*df.columns), path


def cut_lineage(df: DataFrame, label: str = "work") -> DataFrame:
    return store(df, label)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Remove a copy that ``store`` made and nothing reads any more."""
    delete_folder(spark, path)
