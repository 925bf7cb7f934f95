"""Session helpers: one place for the configs every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(app: str = "ridewise", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session or build one with AQE and skew handling on.

    On a cluster the master, memory and checkpoint folder come from the
    submit command; the defaults here only matter for local runs and tests.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master and master.startswith("local"):
        b = b.config("spark.driver.memory", "8g")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster sets it; only a local session without one gets a scratch
    folder of its own (tests, laptops).
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="ridewise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that its path names (a shared store on a cluster)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clear_work(spark: SparkSession) -> None:
    """Delete this application's stages and work copies; stored models stay."""
    root, app = f"{checkpoint_dir(spark).rstrip('/')}/ridewise", spark.sparkContext.applicationId
    for path in (f"{root}/work/{app}", f"{root}/{app}"):
        delete_folder(spark, path)
