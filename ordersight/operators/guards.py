"""All-or-nothing batch validity for the downstream scans (SRC-07..10, ML-12).

Ingest rejects single rows; the training, scoring and metric scans instead skip
a whole batch when any of its rows is unusable (the batch is then reported
once, with the first offending position).  One aggregate per batch, then an
anti-join of the bad batches -- no per-batch collect.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import finite_number, strict_iso_timestamp


def usable_training_row(distance: Column, prep: Column, label: Column) -> Column:
    """FLT-11: any finite distance and prep (blanks around a number are allowed), label exactly 0/1."""
    number = lambda c: finite_number(F.regexp_replace(c, r"^\s+|\s+$", ""))
    return number(distance).isNotNull() & number(prep).isNotNull() & label.isin("0", "1")


def usable_prediction_row(probability: Column, flag: Column) -> Column:
    """SRC-10: a numeric probability and a flag of 0 or 1."""
    return finite_number(probability).isNotNull() & flag.isin("0", "1")


def usable_feature_time(ts_text: Column) -> Column:
    """SRC-09: the order timestamp parses in the canonical format."""
    return strict_iso_timestamp(ts_text).isNotNull()


def batch_guard(rows: DataFrame, usable: Column, reason: str, keys: Sequence[str] = ("batch",),
                order: str = "pos") -> DataFrame:
    """Per batch: ``usable`` (all rows pass) and, if not, the first failing position and a reason."""
    ok = F.coalesce(usable, F.lit(False))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("long").alias("rows"),
        F.min(F.when(~ok, F.col(order))).alias("first_bad_pos")) \
        .select(*keys, "rows", F.col("first_bad_pos").isNull().alias("usable"), "first_bad_pos",
                F.when(F.col("first_bad_pos").isNotNull(),
                       F.concat(F.lit(reason + " at position "), F.col("first_bad_pos").cast("string")))
                .alias("skip_reason"))


def keep_usable(rows: DataFrame, guard: DataFrame, keys: Sequence[str] = ("batch",)) -> DataFrame:
    """Rows of usable batches only (anti-join of the skipped ones)."""
    bad = guard.where(~F.col("usable")).select(*keys)
    return rows.join(bad, list(keys), "left_anti")


def required_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """FLT-12: missing required columns (checked at plan time, before any job runs)."""
    return [c for c in required if c not in df.columns]
