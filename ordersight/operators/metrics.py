"""Windowed health metrics over features, predictions and rejects.

Windows are anchored to the data: ``end = floor(newest, bucket) + bucket`` and
``start = end - window``; the anchor is a scalar subquery (computed once, then a
literal for the rest of the plan), so no join is needed to bring it to the rows.
Callers that know it already (the catalogue: once per stage table) pass ``end`` as a
literal, and window tests compare the timestamp column itself (``within``), so the
range is pushed into the Parquet scan.
All time arithmetic is on whole epoch seconds; since the bounds are whole
seconds, ``floor(ts)`` in ``[start, end)`` is the same test as ``ts`` in it.

Series are built as ``per-slot aggregate  RIGHT JOIN  spine`` where the spine
has at most ``MAX_BUCKETS`` rows (validated in ``WindowOptions``), so it is
always broadcast and the big side is aggregated map-side before any shuffle.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import checkpoint_version
from ..options import REASON_LABELS, WindowOptions


def epoch(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_seconds(c)


# ---------- anchoring ----------

def newest_epoch(features: DataFrame, ts: str = "timestamp") -> Column:
    """Scalar subquery: newest order time (epoch seconds) of the feature table."""
    return features.agg(F.max(epoch(ts))).scalar()


def end_epoch(features: DataFrame, opts: WindowOptions, ts: str = "timestamp") -> Column:
    b = opts.bucket_seconds
    return F.floor(newest_epoch(features, ts) / F.lit(b)) * F.lit(b) + F.lit(b)


def window_bounds(features: DataFrame, opts: WindowOptions, ts: str = "timestamp") -> DataFrame:
    """One row: newest, window start/end and previous-window start (DT-03/04)."""
    b, w = opts.bucket_seconds, opts.window_seconds
    agg = features.agg(F.max(epoch(ts)).alias("newest_s"), F.min(epoch(ts)).alias("oldest_s"))
    end = F.floor(F.col("newest_s") / F.lit(b)) * F.lit(b) + F.lit(b)
    return agg.select(
        F.timestamp_seconds("newest_s").alias("newest"),
        F.timestamp_seconds(end - F.lit(w)).alias("window_start"),
        F.timestamp_seconds(end).alias("window_end"),
        F.timestamp_seconds(end - F.lit(2 * w)).alias("prev_start"),
        # the previous window counts only when the data covers it (first bucket may be partial)
        (F.col("oldest_s") < end - F.lit(2 * w) + F.lit(b)).alias("has_previous"))


def _bounds(features: DataFrame, opts: WindowOptions, end: Column | None, ts: str):
    end_s = end_epoch(features, opts, ts) if end is None else end
    return end_s - F.lit(opts.window_seconds), end_s


def in_window(ts_epoch: Column, start_s: Column, end_s: Column) -> Column:
    """Half-open ``[start, end)`` (FLT-10) on epoch seconds."""
    return (ts_epoch >= start_s) & (ts_epoch < end_s)


def within(ts: str | Column, start_s: Column, end_s: Column) -> Column:
    """Half-open ``[start, end)`` (FLT-10) on a timestamp column, for whole-second bounds.

    The same test as ``in_window(epoch(ts), ...)``, but the column itself is compared, so
    with literal bounds (an explicit ``end``) the filter reaches the Parquet scan and
    only the window's row groups are read.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    return (c >= F.timestamp_seconds(start_s)) & (c < F.timestamp_seconds(end_s))


def slot_index(ts_epoch: Column, start_s: Column, bucket_seconds: int) -> Column:
    """DT-05: ``(ts - start) // bucket``."""
    return F.floor((ts_epoch - start_s) / F.lit(bucket_seconds)).cast("long")


def spine(spark, opts: WindowOptions, start_s: Column) -> DataFrame:
    """All bucket slots of the window (at most MAX_BUCKETS rows)."""
    return spark.range(opts.n_buckets).select(
        F.col("id").alias("slot"),
        F.timestamp_seconds(start_s + F.col("id") * F.lit(opts.bucket_seconds)).alias("bucket_start"))


# ---------- volume ----------

def bucket_of(ts_epoch: Column, bucket_seconds: int) -> Column:
    """Epoch-aligned bucket number (DT-03)."""
    return F.floor(ts_epoch / F.lit(bucket_seconds)).cast("long")


def sample_volume(features: DataFrame, opts: WindowOptions, end: Column | None = None,
                  ts: str = "timestamp", previous: bool = False) -> DataFrame:
    """AGG-13: orders with a timestamp in the window (or the window before it)."""
    start_s, end_s = _bounds(features, opts, end, ts)
    if previous:
        start_s, end_s = start_s - F.lit(opts.window_seconds), start_s
    return features.where(within(ts, start_s, end_s)).agg(
        F.count(F.lit(1)).cast("long").alias("orders"))


def volume_over_time(features: DataFrame, opts: WindowOptions, end: Column | None = None,
                     ts: str = "timestamp") -> DataFrame:
    """AGG-14: orders per bucket across the window; an empty bucket is 0 (the feed stalled).

    Rows are first counted per epoch bucket (partial aggregation map-side, one row
    per bucket after the shuffle).  The data anchor is the newest bucket of that
    small aggregate, so the feature rows are read once; with an explicit ``end``
    the window filter is applied before the aggregation instead.
    """
    b = opts.bucket_seconds
    t = epoch(ts)
    rows = features if end is None else features.where(
        within(ts, end - F.lit(opts.window_seconds), end))
    per_bucket = rows.groupBy(bucket_of(t, b).alias("bucket")).agg(
        F.count(F.lit(1)).cast("long").alias("orders"))
    sp = bucket_spine(per_bucket, opts, end, weight="orders")
    # the spine derives from the same aggregate, so its shuffle is reused; joining on
    # the aggregate's own key keeps the window test off the row-level plan
    return (sp.join(per_bucket, "bucket", "left")
            .select("slot", "bucket_start", F.coalesce("orders", F.lit(0)).cast("long").alias("orders")))


def bucket_spine(per_bucket: DataFrame, opts: WindowOptions, end: Column | None = None,
                 weight: str | None = None) -> DataFrame:
    """The window's buckets (``slot``, epoch ``bucket``, ``bucket_start``).

    Anchored to the newest bucket of a per-bucket aggregate (one-row aggregate,
    exploded into at most MAX_BUCKETS rows; empty input gives no buckets), or to an
    explicit ``end`` in epoch seconds.  ``weight`` names a count column of the
    aggregate; summing it keeps the optimizer from replacing the anchor with a
    second pass over the rows.
    """
    b, n = opts.bucket_seconds, opts.n_buckets
    if end is None:
        aggs = [F.max("bucket").alias("_last")] + ([F.sum(weight).alias("_w")] if weight else [])
        anchor = per_bucket.agg(*aggs).select((F.col("_last") + F.lit(1 - n)).alias("_first"))
    else:
        anchor = per_bucket.sparkSession.range(1).select(
            (F.floor(end / F.lit(b)).cast("long") - F.lit(n)).alias("_first"))
    return anchor.select(F.posexplode(F.sequence(F.col("_first"), F.col("_first") + F.lit(n - 1)))
                         .alias("slot", "bucket")) \
        .select(F.col("slot").cast("long").alias("slot"), "bucket",
                F.timestamp_seconds(F.col("bucket") * F.lit(b)).alias("bucket_start"))


# ---------- predictions joined to order time ----------

def feature_lookup(features: DataFrame, ts: str = "timestamp", unique_keys: bool = False) -> DataFrame:
    """(batch, order_id) -> timestamp, one row per key (SET-03, first by file position).

    ``unique_keys``: the caller guarantees one row per key (the cleaned feature table:
    the cascade claims each id's first occurrence and rejects every later one), so no
    dedup aggregate (a shuffle of every feature row) is needed.
    """
    if unique_keys:
        return features.select("batch", "order_id", ts)
    return features.groupBy("batch", "order_id").agg(
        F.min_by(F.col(ts), F.col("pos")).alias(ts) if "pos" in features.columns
        else F.min(ts).alias(ts))


def join_predictions(predictions: DataFrame, features: DataFrame, ts: str = "timestamp",
                     unique_keys: bool = False) -> DataFrame:
    """JN-03: predictions with their order time, inner join on (batch, order_id), many-to-one."""
    return predictions.join(feature_lookup(features, ts, unique_keys), ["batch", "order_id"], "inner")


def orphan_predictions(predictions: DataFrame, features: DataFrame) -> DataFrame:
    """JN-04: predictions with no feature row (a broken join)."""
    keys = features.select("batch", "order_id")
    return predictions.join(keys, ["batch", "order_id"], "left_anti")


def late_flag_rate_over_time(predictions: DataFrame, features: DataFrame, opts: WindowOptions,
                             end: Column | None = None, ts: str = "timestamp",
                             unique_keys: bool = False) -> DataFrame:
    """AGG-15: % of predictions flagged late per bucket (0-100); a bucket without predictions is NULL.

    With ``unique_keys`` the window filter runs on the feature rows before the join
    (with a literal ``end`` it reaches the scan), so only the window's orders are joined.
    """
    start_s, end_s = _bounds(features, opts, end, ts)
    lookup = features.where(within(ts, start_s, end_s)) if unique_keys else features
    joined = join_predictions(predictions, lookup, ts, unique_keys)
    t = epoch(ts)
    rates = (joined.where(within(ts, start_s, end_s))
             .groupBy(slot_index(t, start_s, opts.bucket_seconds).alias("slot"))
             .agg(F.count(F.lit(1)).cast("long").alias("scored"),
                  F.sum("predicted_late").cast("long").alias("flagged")))
    sp = spine(features.sparkSession, opts, start_s)
    return sp.join(F.broadcast(rates), "slot", "left").select(
        "slot", "bucket_start", F.coalesce("scored", F.lit(0)).cast("long").alias("scored"),
        (F.lit(100.0) * F.col("flagged") / F.col("scored")).alias("flagged_late_pct"))


# ---------- score summary ----------

def score_summary(predictions: DataFrame, exact: bool = True) -> DataFrame:
    """AGG-16/17/19: n, flag rate %, mean probability, p10/p50/p90 (linear), current checkpoint.

    Percentiles are exact: probabilities are stored at 3 dp, so a histogram of at most
    1001 distinct values carries them, whatever the row count (pre-aggregated map-side).
    The mean is an exact integer sum of milli-probabilities.  Empty input gives n = 0 and NULLs.
    """
    if not exact:
        # for probabilities not on the 3-dp contract: the histogram would grow with the data,
        # so quantiles come from Spark's bounded-memory sketch instead
        return predictions.agg(
            F.count(F.lit(1)).cast("long").alias("n"),
            (F.lit(100.0) * F.sum("predicted_late") / F.count(F.lit(1))).alias("flag_rate"),
            F.avg("late_probability").alias("mean_probability"),
            F.percentile_approx("late_probability", [0.1, 0.5, 0.9], 10000).alias("q"),
            F.max_by("checkpoint_id", checkpoint_version(F.col("checkpoint_id"))).alias("current_checkpoint")) \
            .select("n", "flag_rate", "mean_probability", F.col("q")[0].alias("p10"), F.col("q")[1].alias("p50"),
                    F.col("q")[2].alias("p90"), "current_checkpoint")
    hist = predictions.groupBy(F.col("late_probability").alias("p")).agg(
        F.count(F.lit(1)).alias("c"), F.sum("predicted_late").alias("f"))
    stats = hist.agg(
        F.sum("c").cast("long").alias("n"),
        F.sum("f").cast("long").alias("flagged"),
        F.sum(F.col("c") * F.round(F.col("p") * 1000).cast("long")).cast("long").alias("milli_sum"),
        F.percentile(F.col("p"), F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)), F.col("c")).alias("q"))
    current = (predictions.groupBy("checkpoint_id").agg(F.count(F.lit(1)).alias("rows"))
               .agg(F.max_by("checkpoint_id", checkpoint_version(F.col("checkpoint_id")))).scalar())
    return stats.select(
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        (F.lit(100.0) * F.col("flagged") / F.col("n")).alias("flag_rate"),
        (F.col("milli_sum") / F.col("n") / F.lit(1000.0)).alias("mean_probability"),
        F.col("q")[0].alias("p10"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p90"),
        current.alias("current_checkpoint"))


def rows_per_checkpoint(predictions: DataFrame) -> DataFrame:
    """AGG-18/19 with STR-02: rows per checkpoint and its numeric version."""
    return predictions.groupBy("checkpoint_id").agg(F.count(F.lit(1)).cast("long").alias("rows")) \
        .withColumn("version", checkpoint_version(F.col("checkpoint_id")))


# ---------- drops and failures (batch clock) ----------

def drop_rate(features: DataFrame, rejects: DataFrame, opts: WindowOptions,
              end: Column | None = None, ts: str = "timestamp", previous: bool = False) -> DataFrame:
    """AGG-20: rejected / (kept + rejected) in %, windowed by *batch* time; NULL if no rows."""
    start_s, end_s = _bounds(features, opts, end, ts)
    if previous:
        start_s, end_s = start_s - F.lit(opts.window_seconds), start_s
    kept = features.where(within("batch_time", start_s, end_s)).agg(
        F.count(F.lit(1)).cast("long").alias("kept"))
    rej = rejects.where(within("batch_time", start_s, end_s)).agg(
        F.count(F.lit(1)).cast("long").alias("rejected"))
    return kept.select(
        "kept", rej.scalar().alias("rejected")).select(
        "kept", "rejected",
        F.when(F.col("kept") + F.col("rejected") > 0,
               F.lit(100.0) * F.col("rejected") / (F.col("kept") + F.col("rejected"))).alias("drop_rate"))


def reason_label(reason: Column) -> Column:
    """JN-05 as a literal map lookup (no join); unknown codes pass through."""
    pairs = []
    for code, label in REASON_LABELS.items():
        pairs += [F.lit(code), F.lit(label)]
    return F.coalesce(F.create_map(*pairs)[reason], reason)


def failure_counts(rejects: DataFrame, features: DataFrame, opts: WindowOptions,
                   end: Column | None = None, ts: str = "timestamp") -> DataFrame:
    """AGG-21 + SRT-03: rows dropped per labelled reason in the window, ranked (count desc, label asc)."""
    start_s, end_s = _bounds(features, opts, end, ts)
    counts = (rejects.where(within("batch_time", start_s, end_s))
              .groupBy(reason_label(F.col("reason")).alias("label"))
              .agg(F.count(F.lit(1)).cast("long").alias("rows_dropped")))
    # one row per distinct label: a tiny, bounded window
    w = Window.orderBy(F.desc("rows_dropped"), F.asc("label"))
    return counts.withColumn("rnk", F.row_number().over(w).cast("long")) \
                 .withColumn("share", F.col("rows_dropped") / F.sum("rows_dropped").over(Window.partitionBy()))


# ---------- KPIs ----------

def kpi_numbers(features: DataFrame, rejects: DataFrame, predictions: DataFrame,
                opts: WindowOptions, ts: str = "timestamp", end: Column | None = None,
                unique_keys: bool = False) -> DataFrame:
    """AGG-24/FND-05: current and previous window numbers in one conditional-aggregation pass each.

    Deltas are only given when the previous window is fully covered by data.
    """
    b, w = opts.bucket_seconds, opts.window_seconds
    end_s = end_epoch(features, opts, ts) if end is None else end
    start_s = end_s - F.lit(w)
    prev_s = start_s - F.lit(w)
    t = epoch(ts)
    cur, prev = within(ts, start_s, end_s), within(ts, prev_s, start_s)
    bcur, bprev = within("batch_time", start_s, end_s), within("batch_time", prev_s, start_s)
    f = features.agg(
        F.count_if(cur).cast("long").alias("orders"),
        F.count_if(prev).cast("long").alias("prev_orders"),
        F.count_if(bcur).cast("long").alias("kept"),
        F.count_if(bprev).cast("long").alias("prev_kept"),
        (F.min(t) < prev_s + F.lit(b)).alias("has_previous"))
    r = rejects.agg(F.count_if(bcur).cast("long").alias("rejected"),
                    F.count_if(bprev).cast("long").alias("prev_rejected"))
    lookup = features.where(within(ts, prev_s, end_s)) if unique_keys else features
    j = join_predictions(predictions, lookup, ts, unique_keys)
    p = j.agg(F.count_if(within(ts, start_s, end_s)).cast("long").alias("scored"),
              F.sum(F.when(within(ts, start_s, end_s), F.col("predicted_late"))).cast("long").alias("flagged"),
              F.count_if(within(ts, prev_s, start_s)).cast("long").alias("prev_scored"),
              F.sum(F.when(within(ts, prev_s, start_s), F.col("predicted_late"))).cast("long").alias("prev_flagged"))
    def rate(num, den):
        return F.when(F.col(den) > 0, F.lit(100.0) * F.col(num) / F.col(den))
    one_row = f.select("*", *[r.select(c).scalar().alias(c) for c in r.columns],
                       *[p.select(c).scalar().alias(c) for c in p.columns])
    out = one_row.select(
        "orders", "has_previous",
        F.when(F.col("kept") + F.col("rejected") > 0,
               F.lit(100.0) * F.col("rejected") / (F.col("kept") + F.col("rejected"))).alias("drop_rate"),
        rate("flagged", "scored").alias("flag_rate"),
        F.when(F.col("has_previous"), F.col("prev_orders")).alias("prev_orders"),
        F.when(F.col("has_previous") & (F.col("prev_kept") + F.col("prev_rejected") > 0),
               F.lit(100.0) * F.col("prev_rejected") / (F.col("prev_kept") + F.col("prev_rejected"))).alias("prev_drop_rate"),
        F.when(F.col("has_previous"), rate("prev_flagged", "prev_scored")).alias("prev_flag_rate"))
    return out


# ---------- keyed series (many series in one job) ----------

def keyed_spine(keys_df: DataFrame, keys: list, first_bucket: Column, opts: WindowOptions) -> DataFrame:
    """Every (key, slot) of the window, generated from the distinct keys (no join)."""
    n, b = opts.n_buckets, opts.bucket_seconds
    return keys_df.select(*keys, F.posexplode(F.sequence(first_bucket, first_bucket + F.lit(n - 1)))
                          .alias("slot", "bucket")) \
        .select(*keys, F.col("slot").cast("long").alias("slot"), "bucket",
                F.timestamp_seconds(F.col("bucket") * F.lit(b)).alias("bucket_start"))


def volume_over_time_by(features: DataFrame, opts: WindowOptions, keys: list,
                        ts: str = "timestamp", end: Column | None = None) -> DataFrame:
    """AGG-14 per key, on the shared data-anchored window; empty buckets are 0."""
    b = opts.bucket_seconds
    end_s = end_epoch(features, opts, ts) if end is None else end
    first_bucket = F.floor(end_s / F.lit(b)).cast("long") - F.lit(opts.n_buckets)
    t = epoch(ts)
    rows = features.where(within(ts, end_s - F.lit(opts.window_seconds), end_s))
    per = rows.groupBy(*keys, bucket_of(t, b).alias("bucket")).agg(F.count(F.lit(1)).cast("long").alias("orders"))
    sp = keyed_spine(features.select(*keys).distinct(), keys, first_bucket, opts)
    return sp.join(per, [*keys, "bucket"], "left").select(
        *keys, "slot", "bucket_start", F.coalesce("orders", F.lit(0)).cast("long").alias("orders"))


def late_flag_rate_over_time_by(predictions: DataFrame, features: DataFrame, opts: WindowOptions,
                                keys: list, ts: str = "timestamp", end: Column | None = None,
                                unique_keys: bool = False) -> DataFrame:
    """AGG-15 per key (keys are feature columns); buckets without predictions are NULL."""
    b = opts.bucket_seconds
    end_s = end_epoch(features, opts, ts) if end is None else end
    first_bucket = F.floor(end_s / F.lit(b)).cast("long") - F.lit(opts.n_buckets)
    if unique_keys:     # one row per key already (see feature_lookup): filter to the window, no dedup
        lookup = features.where(within(ts, end_s - F.lit(opts.window_seconds), end_s)) \
            .select("batch", "order_id", ts, *keys)
    else:
        lookup = features.groupBy("batch", "order_id").agg(
            F.min_by(F.struct(F.col(ts).alias(ts), *[F.col(k) for k in keys]), F.col("pos")).alias("_f")) \
            .select("batch", "order_id", "_f.*")
    j = predictions.join(lookup, ["batch", "order_id"], "inner")
    t = epoch(ts)
    per = (j.where(within(ts, end_s - F.lit(opts.window_seconds), end_s))
           .groupBy(*keys, bucket_of(t, b).alias("bucket"))
           .agg(F.count(F.lit(1)).cast("long").alias("scored"), F.sum("predicted_late").cast("long").alias("flagged")))
    sp = keyed_spine(features.select(*keys).distinct(), keys, first_bucket, opts)
    return sp.join(per, [*keys, "bucket"], "left").select(
        *keys, "slot", "bucket_start", F.coalesce("scored", F.lit(0)).cast("long").alias("scored"),
        (F.lit(100.0) * F.col("flagged") / F.col("scored")).alias("flagged_late_pct"))


def kpi_deltas(numbers: DataFrame) -> DataFrame:
    """FND-05: KPI values, deltas (only with a fully covered previous window) and display text."""
    from ..functions.scalars import pct_text, signed_thousands, thousands
    hp = F.col("has_previous")
    out = numbers.select(
        "orders", "drop_rate", "flag_rate", "has_previous",
        F.when(hp, F.col("orders") - F.col("prev_orders")).alias("orders_delta"),
        (F.bround(F.col("drop_rate") - F.col("prev_drop_rate"), 1) + F.lit(0.0)).alias("drop_delta_pp"),
        (F.bround(F.col("flag_rate") - F.col("prev_flag_rate"), 0) + F.lit(0.0)).alias("flag_delta_pp"))
    return out.select(
        "*", thousands(F.col("orders")).alias("orders_text"),
        F.when(hp, signed_thousands(F.col("orders_delta"))).alias("orders_delta_text"),
        pct_text(F.col("drop_rate"), 1).alias("drop_rate_text"),
        F.when(F.col("flag_rate").isNull(), F.lit("—"))
         .otherwise(F.format_string("%.0f%%", F.bround(F.col("flag_rate"), 0))).alias("flag_rate_text"),
        F.when(F.col("drop_delta_pp").isNotNull(),
               F.format_string("%+.1f pp", F.col("drop_delta_pp"))).alias("drop_delta_text"),
        F.when(F.col("flag_delta_pp").isNotNull(),
               F.format_string("%+.0f pp", F.col("flag_delta_pp"))).alias("flag_delta_text"),
        # delta polarity: more orders is good, more drops is bad, the flag rate is neutral
        F.lit("normal").alias("orders_polarity"), F.lit("inverse").alias("drop_polarity"),
        F.lit("off").alias("flag_polarity"))
