"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersight.session import checkpoint_dir

WORD = re.compile(r"[^\W_]+")
LETTERS = re.compile(r"[^\W\d_]+")

#: Rows of one Arrow batch: bounds what a Python worker holds when single texts are very long.
BATCH_ROWS = 512


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the session's Arrow batch size to ``rows`` (never raise it) and tell workers where the package is."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
    # workers that start elsewhere (a local session of another folder) find this package as the driver did
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(id_col: Column, folds: int) -> Column:
    """crc32(id as text) mod ``folds``; null ids have none."""
    return F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % folds


def held_out(id_col: Column, folds: int, test: int) -> Column:
    return F.coalesce(fold(id_col, folds) == test, F.lit(False))


def sampled(id_col: Column, fraction: float, salt: str) -> Column:
    """A hash-chosen share of the ids: the same rows on every run and for any partitioning."""
    return F.pmod(F.xxhash64(id_col.cast("string"), F.lit(salt)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, fraction))


class Memo(dict):
    """value = memo[key]; computes missing values and starts anew when it holds ``cap`` keys."""

    def __init__(self, fn: Callable, cap: int = 200_000):
        super().__init__()
        self.fn, self.cap = fn, cap

    def __missing__(self, key):
        if len(self) >= self.cap:
            self.clear()
        value = self[key] = self.fn(key)
        return value


def hash_word(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))


def mix(x: np.ndarray, salt: int | np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply, xor-shift) over uint64 values; an array of salts is broadcast."""
    x = (x ^ (np.uint64(salt) if isinstance(salt, int) else salt)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema) -> DataFrame:
    """``mapInArrow`` of a function on single batches; empty batches are not passed to it."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, name: str) -> list[str]:
    """The column's texts; null is empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]
