"""Batch ledger: the exactly-once bookkeeping of the stage jobs.

One row per (batch, stage) once the stage has committed that batch, including
batches that produced zero rows (a zero-row batch leaves no data rows, so data
tables alone cannot tell "done" from "not yet").
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..options import REJECT_REASONS

LEDGER_SCHEMA = ("batch string, stage string, rows_in long, kept long, rejected long, "
                 "reasons map<string,long>, status string, skip_reason string, committed_at timestamp")


def pending(batches: DataFrame, ledger: DataFrame, stage: str | None = None) -> DataFrame:
    """JN-01/02, SET-02: batches with no committed ledger row (for ``stage`` when the ledger has stages)."""
    done = ledger if stage is None or "stage" not in ledger.columns else ledger.where(F.col("stage") == stage)
    return batches.select("batch").distinct().join(done.select("batch"), "batch", "left_anti")


def ledger_rows(stats: DataFrame, stage: str, committed_at=None) -> DataFrame:
    """SNK-05: ledger rows from per-batch stats (``batch_stats``), reasons as a map.

    ``committed_at`` is a Column, a literal timestamp, or None for the commit clock.
    """
    reasons = F.map_from_arrays(F.array(*[F.lit(r) for r in REJECT_REASONS]),
                                F.array(*[F.col(r) for r in REJECT_REASONS]))
    if committed_at is None:
        ts = F.current_timestamp()
    elif isinstance(committed_at, Column):
        ts = committed_at
    else:
        ts = F.lit(committed_at).cast("timestamp")
    return stats.select("batch", F.lit(stage).alias("stage"), "rows_in", "kept", "rejected",
                        F.map_filter(reasons, lambda k, v: v > 0).alias("reasons"),
                        F.lit("committed").alias("status"), F.lit(None).cast("string").alias("skip_reason"),
                        ts.alias("committed_at"))


def quarantine_rows(bad: DataFrame, stage: str) -> DataFrame:
    """ST-08: a skipped batch is recorded once (status ``skipped`` + reason) and never retried in the run."""
    return bad.select("batch", F.lit(stage).alias("stage"), F.lit(0).cast("long").alias("rows_in"),
                      F.lit(0).cast("long").alias("kept"), F.lit(0).cast("long").alias("rejected"),
                      F.create_map().cast("map<string,bigint>").alias("reasons"),
                      F.lit("skipped").alias("status"), F.col("reason").alias("skip_reason"),
                      F.current_timestamp().alias("committed_at"))


def subset_check(previous: DataFrame, current: DataFrame) -> DataFrame:
    """SET-04: True when every previously seen batch is still present (append-only), else a full refresh is due."""
    gone = previous.select("batch").join(current.select("batch"), "batch", "left_anti")
    return gone.agg((F.count(F.lit(1)) == 0).alias("append_only"))


def folder_counts(ledger: DataFrame, run_started_at=None) -> DataFrame:
    """AGG-23: readable (committed) batches per stage, and how many were first seen in this run."""
    first = ledger.where(F.col("status") == "committed").groupBy("stage", "batch").agg(
        F.min("committed_at").alias("first_seen"))
    new = F.count_if(F.col("first_seen") >= F.lit(run_started_at).cast("timestamp")) if run_started_at is not None \
        else F.lit(0).cast("long")
    return first.groupBy("stage").agg(F.count(F.lit(1)).cast("long").alias("batches"), new.cast("long").alias("new_batches"))
