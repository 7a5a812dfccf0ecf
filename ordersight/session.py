"""Session helpers.

Only settings the library relies on for *correct* results are enforced here
(UTC session clock).  Everything else is a default for local runs; on a cluster
the submitter's configuration wins.
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
}


# Settings this engine is designed around on a large cluster (the submitter applies them; nothing
# here overrides a cluster's configuration).  AQE sizes shuffle partitions from the advisory size,
# splits skewed join partitions, and converts joins to broadcast only when a side's runtime size is
# under the threshold; scan splits are sized so a task's input fits comfortably in executor memory.
CLUSTER_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # Upper bound, sized for the largest shuffle: the cleaning job's row-level join at ~100 TB of
    # input gives ~1 GB per partition before AQE.  AQE coalesces small shuffles toward the 256m
    # advisory size but never splits a non-skewed partition, so a low bound would spill.
    "spark.sql.shuffle.partitions": "100000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ordersight", extra: dict | None = None) -> SparkSession:
    """A local[N] session for tests and the bench (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(LOCAL_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("ORDERSIGHT_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Hours, peak flags and bucket floors are defined in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def compiled_methods(spark: SparkSession) -> None:
    """Lower the session's bound on generated methods to what the JVM compiles (never raise it).

    The JVM only interprets methods over 8000 bytes; the cleaning rules in one method are larger.
    Above the bound Spark runs the same expressions from small methods instead.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key, "65535")) > 8000:
        spark.conf.set(key, "8000")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset (local tests) do we pick a scratch folder of our own.
    """
    configured = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        # a machine-local folder is not visible to the executors of a cluster
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="ordersight-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return checkpoint_dir(spark)
