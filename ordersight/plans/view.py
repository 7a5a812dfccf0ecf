"""FND-06: the whole health view as a bundle of lazy DataFrames.

Composition only: every number comes from an operator in ``operators``; empty
inputs give NULLs and empty series, never an error.  ``now`` is a parameter (the
wall clock), so the view is a pure function of the tables.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import format_iso
from ..operators import findings, metrics
from ..options import WindowOptions


@dataclass
class PulseView:
    bounds: DataFrame
    kpis: DataFrame
    volume: DataFrame
    volume_finding: DataFrame
    flag_rate: DataFrame
    flag_finding: DataFrame
    failures: DataFrame
    failures_finding: DataFrame
    summary: DataFrame          # one row: caption/provenance + statuses


def pulse_view(features: DataFrame, rejects: DataFrame, predictions: DataFrame, opts: WindowOptions,
               now: Column, newest_model: DataFrame | None = None, end: Column | None = None,
               unique_keys: bool = False) -> PulseView:
    """``end`` (literal window end, epoch seconds) and ``unique_keys`` (one feature row per
    (batch, order_id)) are passed on to the metrics; see ``metrics.within``."""
    bounds = metrics.window_bounds(features, opts)
    kpis = metrics.kpi_deltas(metrics.kpi_numbers(features, rejects, predictions, opts, end=end,
                                                  unique_keys=unique_keys))
    newest = features.agg(F.max("timestamp")).scalar()
    volume = metrics.volume_over_time(features, opts, end=end)
    vf = findings.volume_finding(volume, opts.n_buckets, opts.bucket_minutes,
                                 idle_minutes=findings.idle_minutes(newest, now))
    flag = metrics.late_flag_rate_over_time(predictions, features, opts, end=end, unique_keys=unique_keys)
    ff = findings.flag_finding(flag, opts.n_buckets, window_rate=kpis.select("flag_rate").scalar())
    fails = metrics.failure_counts(rejects, features, opts, end=end)
    fails_f = findings.failures_finding(fails, opts.window_minutes)
    # scored-by: the newest checkpoint among predictions inside the window
    end_s = metrics.end_epoch(features, opts) if end is None else end
    start_s = end_s - F.lit(opts.window_seconds)
    lookup = features.where(metrics.within("timestamp", start_s, end_s)) if unique_keys else features
    window_preds = metrics.join_predictions(predictions, lookup, unique_keys=unique_keys).where(
        metrics.within("timestamp", start_s, end_s))
    scored_by = metrics.score_summary(window_preds).select("current_checkpoint").scalar()
    model = newest_model.select("checkpoint_id").scalar() if newest_model is not None else F.lit(None).cast("string")
    summary = bounds.select(
        model.alias("newest_model"), scored_by.alias("scored_by"),
        format_iso(F.col("newest")).alias("data_through"),
        F.concat(F.date_format("newest", "HH:mm"), F.lit("Z")).alias("data_through_hhmm"),
        F.lit(f"last {opts.window_minutes} min").alias("window"),
        findings.clock_finding(F.col("newest"), now).alias("clock"),
        vf.select("status").scalar().alias("volume_status"),
        ff.select("status").scalar().alias("flag_status"),
        fails_f.select("top_label").scalar().alias("top_failure"))
    return PulseView(bounds, kpis, volume, vf, flag, ff, fails, fails_f, summary)
