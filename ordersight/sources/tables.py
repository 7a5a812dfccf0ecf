"""Driver tables (one parquet file/folder per table)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give row-heavy work enough even tasks when the input has too few files.

    A row group is read by one task, however many splits its file is cut into, so the number of
    scan partitions says nothing about the tasks that get rows.  Only the files do: with fewer
    files than the cluster's cores, the input is round-robin repartitioned; a normal many-file
    input is left alone, so there is no extra shuffle at scale.  Deciding needs only the file
    listing, not a job.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= target:
        return df
    return df.repartition(max(target, df.rdd.getNumPartitions()))
