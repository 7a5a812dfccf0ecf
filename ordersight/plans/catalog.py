"""The query catalogue: ``queries()`` (Spark) and ``oracle_sql()`` (DuckDB) by the same keys.

Every query reads the driver tables (through the feed adapter) so its work grows
with them.  Output conventions shared with the oracle: timestamps as
``yyyy-MM-dd HH:mm:ss`` text, counts BIGINT, ratios computed from integers,
every column aliased.
"""
from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import format_iso
from ..operators import metrics, quality
from .context import FeedContext
from .oracle import cte

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _iso_sql(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


# ---------------------------------------------------------------- sources


@register("raw_feed", cte("", """
SELECT batch, """ + _iso_sql("batch_time") + """ AS batch_time, pos, raw_line FROM raw"""))
def q_raw_feed(spark, sf_dir):
    raw = FeedContext(spark, sf_dir).raw()
    return raw.select("batch", format_iso(F.col("batch_time")).alias("batch_time"), "pos", "raw_line")


@register("annotated_rows", cte("", """
SELECT batch, pos, t_order_id AS order_id, reason FROM ann"""))
def q_annotated(spark, sf_dir):
    a = FeedContext(spark, sf_dir).annotated()
    return a.select("batch", "pos", F.col("t_order_id").alias("order_id"), "reason")


@register("features", cte("", """
SELECT order_id, """ + _iso_sql("ts") + """ AS timestamp, hour, is_peak, distance_km, prep_minutes,
       order_value, was_late, batch, """ + _iso_sql("batch_time") + """ AS batch_time, pos FROM feat"""))
def q_features(spark, sf_dir):
    f = FeedContext(spark, sf_dir).features()
    return f.select("order_id", format_iso(F.col("timestamp")).alias("timestamp"), "hour", "is_peak",
                    "distance_km", "prep_minutes", "order_value", "was_late", "batch",
                    format_iso(F.col("batch_time")).alias("batch_time"), "pos")


@register("rejects", cte("", """
SELECT order_id, timestamp, distance_km, prep_minutes, order_value, was_late, reason, raw_line, batch, pos
FROM rej"""))
def q_rejects(spark, sf_dir):
    r = FeedContext(spark, sf_dir).rejects()
    return r.drop("batch_time")


_REASON_COLS_SQL = ",\n".join(
    f"  CAST(count(*) FILTER (WHERE reason = '{r}') AS BIGINT) AS {r}"
    for r in ("duplicate_id", "wrong_field_count", "blank", "bad_timestamp", "not_a_number",
              "out_of_range", "bad_label"))
_REASON_TEXT_SQL = "array_to_string(list_filter([" + ", ".join(
    f"CASE WHEN {r} > 0 THEN '{r} ' || {r} END"
    for r in ("duplicate_id", "wrong_field_count", "blank", "bad_timestamp", "not_a_number",
              "out_of_range", "bad_label")) + "], lambda x: x IS NOT NULL), ', ')"

BATCH_STATS_CTE = """bs AS (
SELECT batch, CAST(count(*) AS BIGINT) AS rows_in,
  CAST(count(*) FILTER (WHERE reason IS NULL) AS BIGINT) AS kept,
  CAST(count(*) FILTER (WHERE reason IS NOT NULL) AS BIGINT) AS rejected,
""" + _REASON_COLS_SQL + """
FROM ann GROUP BY batch)"""


@register("batch_stats", cte(BATCH_STATS_CTE, "SELECT *, " + _REASON_TEXT_SQL + " AS reasons_text FROM bs"))
def q_batch_stats(spark, sf_dir):
    return quality.batch_stats(FeedContext(spark, sf_dir).annotated())


@register("volume_over_time", cte("""
b AS (SELECT (floor(epoch(max(ts)) / 3600) * 3600 + 3600)::BIGINT AS end_s FROM feat),
s AS (SELECT range AS slot, make_timestamp(((SELECT end_s FROM b) - 604800 + range * 3600) * 1000000) AS bucket_start FROM range(168)),
c AS (SELECT floor((floor(epoch(ts)) - ((SELECT end_s FROM b) - 604800)) / 3600)::BIGINT AS slot, count(*) AS n
      FROM feat WHERE floor(epoch(ts)) >= (SELECT end_s FROM b) - 604800 AND floor(epoch(ts)) < (SELECT end_s FROM b)
      GROUP BY 1)""", """
SELECT s.slot, strftime(s.bucket_start, '%Y-%m-%d %H:%M:%S') AS bucket_start,
       CAST(coalesce(c.n, 0) AS BIGINT) AS orders
FROM s LEFT JOIN c USING (slot)"""))
def q_volume(spark, sf_dir):
    """AGG-14 over the stored feature table written by the cleaning stage."""
    ctx = FeedContext(spark, sf_dir)
    v = metrics.volume_over_time(ctx.stage()["features"], ctx.window, end=ctx.window_end())
    return v.select("slot", format_iso(F.col("bucket_start")).alias("bucket_start"), "orders")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


# ================================================================ more quality outputs
from ..functions.scalars import batch_key_of, batch_time_of  # noqa: E402
from ..operators import lateness, scoring  # noqa: E402
from ..options import REJECT_REASONS  # noqa: E402

_SPINE_SQL = """
bnd AS (SELECT (floor(max(epoch(ts)) / 3600) * 3600 + 3600)::BIGINT AS end_s,
               min(floor(epoch(ts)))::BIGINT AS oldest_s FROM feat),
spine AS (SELECT range AS slot, ((SELECT end_s FROM bnd) / 3600 - 168 + range) AS bucket,
                 make_timestamp(((SELECT end_s FROM bnd) - 604800 + range * 3600) * 1000000) AS bucket_start
          FROM range(168))"""


@register("batch_key_parse", cte("", """
SELECT DISTINCT 'orders_' || batch || '.csv' AS file_name,
  regexp_extract('orders_' || batch || '.csv', '^orders_(\\d{8}T\\d{6}Z_\\d{4,})\\.csv$', 1) AS batch,
  strftime(strptime(split_part(batch, '_', 1), '%Y%m%dT%H%M%SZ'), '%Y-%m-%d %H:%M:%S') AS batch_time,
  'features_' || batch || '.csv' AS features_file, 'rejects_' || batch || '.csv' AS rejects_file,
  'predictions_' || batch || '.csv' AS predictions_file
FROM raw"""))
def q_batch_key_parse(spark, sf_dir):
    raw = FeedContext(spark, sf_dir).raw()
    names = raw.select(F.concat(F.lit("orders_"), "batch", F.lit(".csv")).alias("file_name")).distinct()
    key = batch_key_of(F.col("file_name"))
    return names.select(
        "file_name", key.alias("batch"), format_iso(batch_time_of(key)).alias("batch_time"),
        F.concat(F.lit("features_"), key, F.lit(".csv")).alias("features_file"),
        F.concat(F.lit("rejects_"), key, F.lit(".csv")).alias("rejects_file"),
        F.concat(F.lit("predictions_"), key, F.lit(".csv")).alias("predictions_file"))


@register("reason_pivot", cte("", """
SELECT batch, """ + ", ".join(
    f"CAST(count(*) FILTER (WHERE reason = '{r}') AS BIGINT) AS {r}" for r in REJECT_REASONS) + """
FROM ann WHERE reason IS NOT NULL GROUP BY batch"""))
def q_reason_pivot(spark, sf_dir):
    rej = FeedContext(spark, sf_dir).rejects()
    # fixed pivot values: no extra job to discover them, one column per rule
    p = rej.groupBy("batch").pivot("reason", list(REJECT_REASONS)).agg(F.count(F.lit(1)))
    return p.select("batch", *[F.coalesce(F.col(r), F.lit(0)).cast("long").alias(r) for r in REJECT_REASONS])


@register("running_totals", cte(BATCH_STATS_CTE, """
SELECT batch, kept, rejected,
  CAST(sum(kept) OVER (ORDER BY batch ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total_kept,
  CAST(sum(rejected) OVER (ORDER BY batch ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total_rejected,
  CAST(count(*) OVER (ORDER BY batch ROWS UNBOUNDED PRECEDING) AS BIGINT) AS files
FROM bs"""))
def q_running_totals(spark, sf_dir):
    stats = FeedContext(spark, sf_dir).stage()["batch_stats"]
    r = quality.running_totals(stats)
    return r.select("batch", "kept", "rejected", F.col("total_kept").cast("long").alias("total_kept"),
                    F.col("total_rejected").cast("long").alias("total_rejected"),
                    F.col("files").cast("long").alias("files"))


@register("run_totals", cte(BATCH_STATS_CTE, """
SELECT CAST(count(*) AS BIGINT) AS files, CAST(sum(kept) AS BIGINT) AS kept,
       CAST(sum(rejected) AS BIGINT) AS rejected FROM bs"""))
def q_run_totals(spark, sf_dir):
    return quality.run_totals(FeedContext(spark, sf_dir).stage()["batch_stats"])


@register("defect_audit", cte("""
dd AS (SELECT batch, pos,
  CASE WHEN pos > min(pos) OVER (PARTITION BY batch, f_order_id) THEN 'duplicate_id'
       WHEN f_order_value = '' THEN 'blank' WHEN f_distance_km = '-1.0' THEN 'negative_distance'
       WHEN f_prep_minutes = 'n/a' THEN 'missing_prep' WHEN f_was_late = 'yes' THEN 'text_label'
       WHEN f_distance_km = '999.0' THEN 'outlier_distance' END AS defect
  FROM fields)""", """
SELECT batch, CAST(count(*) AS BIGINT) AS rows, CAST(count(defect) AS BIGINT) AS messy,
       CAST(count(*) FILTER (WHERE defect = 'duplicate_id') AS BIGINT) AS duplicates
FROM dd GROUP BY batch"""))
def q_defect_audit(spark, sf_dir):
    audit = quality.defect_audit(FeedContext(spark, sf_dir).fields())
    return audit.groupBy("batch").agg(
        F.count(F.lit(1)).cast("long").alias("rows"),
        F.count("defect").cast("long").alias("messy"),
        F.count_if(F.col("defect") == "duplicate_id").cast("long").alias("duplicates"))


@register("late_by_peak", cte("", """
SELECT is_peak, CAST(count(*) AS BIGINT) AS orders, CAST(sum(was_late) AS BIGINT) AS late,
       round(100.0::DOUBLE * sum(was_late) / count(*), 6) AS late_pct
FROM feat GROUP BY is_peak"""))
def q_late_by_peak(spark, sf_dir):
    f = FeedContext(spark, sf_dir).stage()["features"]
    return f.groupBy("is_peak").agg(
        F.count(F.lit(1)).cast("long").alias("orders"), F.sum("was_late").cast("long").alias("late")) \
        .withColumn("late_pct", F.round(F.lit(100.0) * F.col("late") / F.col("orders"), 6))


@register("late_by_distance_band", cte("", """
SELECT CAST(floor(distance_km / 5) * 5 AS INTEGER) AS band_km, CAST(count(*) AS BIGINT) AS orders,
       CAST(sum(was_late) AS BIGINT) AS late, round(100.0::DOUBLE * sum(was_late) / count(*), 6) AS late_pct
FROM feat GROUP BY 1"""))
def q_late_by_band(spark, sf_dir):
    f = FeedContext(spark, sf_dir).stage()["features"]
    return f.groupBy((F.floor(F.col("distance_km") / 5) * 5).cast("int").alias("band_km")).agg(
        F.count(F.lit(1)).cast("long").alias("orders"), F.sum("was_late").cast("long").alias("late")) \
        .withColumn("late_pct", F.round(F.lit(100.0) * F.col("late") / F.col("orders"), 6))


WHAT_IF_THRESHOLDS = (30, 35, 40, 45)


@register("what_if_threshold", cte("""
th AS (SELECT unnest([30, 35, 40, 45]) AS threshold),
tv AS (SELECT 5 + k % 26 AS prep, (5 + (e * 7919) % 146) / 10.0 AS km, (e * 104729) % 17 - 8 AS noise,
              h IN (11, 12, 13, 17, 18, 19, 20) AS peak FROM ev)""", """
SELECT threshold, CAST(count(*) AS BIGINT) AS orders,
  CAST(count(*) FILTER (WHERE CAST(prep AS DOUBLE) + 3.0 * km + CAST(noise AS DOUBLE)
                                  + CASE WHEN peak THEN 8.0 ELSE 0.0 END > threshold) AS BIGINT) AS late
FROM tv, th GROUP BY threshold"""))
def q_what_if(spark, sf_dir):
    ev = FeedContext(spark, sf_dir).events()
    e = F.col("event_id")
    prep = F.lit(5) + F.get_json_object("props", "$.k").cast("long") % 26
    km = (F.lit(5) + (e * 7919) % 146) / F.lit(10.0)
    noise = (e * 104729) % 17 - 8
    peak = F.hour("ts").isin(11, 12, 13, 17, 18, 19, 20)
    # one pass over the events: every threshold is a conditional count of the same rows
    return ev.agg(*[F.count_if(lateness.is_late(prep, km, noise, peak, t, peak_delay=8.0) == 1)
                    .cast("long").alias(f"t{t}") for t in WHAT_IF_THRESHOLDS],
                  F.count(F.lit(1)).cast("long").alias("orders")) \
        .select(F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col("orders"),
                                             F.col(f"t{t}").alias("late"))
                                    for t in WHAT_IF_THRESHOLDS])).alias("r")).select("r.*")


# ================================================================ predictions


@register("predictions_fixed", cte("", """
SELECT order_id, late_probability, predicted_late, checkpoint_id, batch, pos FROM pred"""))
def q_predictions_fixed(spark, sf_dir):
    ctx = FeedContext(spark, sf_dir)
    return scoring.score_fixed(ctx.features(), scoring.GOLDEN_COEFFICIENTS, scoring.GOLDEN_INTERCEPT,
                               "model_v0001")


@register("pandas_udf_scorer", cte("", """
SELECT order_id, late_probability, predicted_late, checkpoint_id, batch, pos FROM pred"""))
def q_pandas_scorer(spark, sf_dir):
    f = FeedContext(spark, sf_dir).stage()["features"]
    model = scoring.CoefficientModel(scoring.GOLDEN_COEFFICIENTS, scoring.GOLDEN_INTERCEPT,
                                     ["distance_km", "prep_minutes"])
    return scoring.score_with_pandas(f, model, ["distance_km", "prep_minutes"], "model_v0001")


@register("scored_per_batch", cte("", """
SELECT batch, CAST(count(*) AS BIGINT) AS scored, CAST(sum(predicted_late) AS BIGINT) AS flagged
FROM pred GROUP BY batch"""))
def q_scored_per_batch(spark, sf_dir):
    return scoring.scored_per_batch(FeedContext(spark, sf_dir).stage()["predictions"])


@register("prediction_join", cte("""
lk AS (SELECT batch, order_id, arg_min(ts, pos) AS ts FROM feat GROUP BY batch, order_id)""", """
SELECT p.batch, p.order_id, p.late_probability, p.predicted_late, """ + _iso_sql("lk.ts") + """ AS timestamp
FROM pred p JOIN lk ON p.batch = lk.batch AND p.order_id = lk.order_id"""))
def q_prediction_join(spark, sf_dir):
    st = FeedContext(spark, sf_dir).stage()
    j = metrics.join_predictions(st["predictions"], st["features"])
    return j.select("batch", "order_id", "late_probability", "predicted_late",
                    format_iso(F.col("timestamp")).alias("timestamp"))


@register("orphan_predictions", cte("", """
SELECT CAST(count(*) AS BIGINT) AS orphans FROM pred p
WHERE NOT EXISTS (SELECT 1 FROM feat f WHERE f.batch = p.batch AND f.order_id = p.order_id)"""))
def q_orphans(spark, sf_dir):
    st = FeedContext(spark, sf_dir).stage()
    return metrics.orphan_predictions(st["predictions"], st["features"]).agg(
        F.count(F.lit(1)).cast("long").alias("orphans"))


@register("actual_vs_predicted", cte("", """
SELECT p.predicted_late, f.was_late, CAST(count(*) AS BIGINT) AS n
FROM pred p JOIN feat f ON p.batch = f.batch AND p.order_id = f.order_id GROUP BY 1, 2"""))
def q_actual_vs_predicted(spark, sf_dir):
    st = FeedContext(spark, sf_dir).stage()
    f = st["features"].select("batch", "order_id", "was_late")
    return st["predictions"].join(f, ["batch", "order_id"]).groupBy("predicted_late", "was_late") \
        .agg(F.count(F.lit(1)).cast("long").alias("n"))


# ================================================================ windows and metrics


@register("window_bounds", cte(_SPINE_SQL, """
SELECT """ + _iso_sql("(SELECT max(ts) FROM feat)") + """ AS newest,
  strftime(make_timestamp((end_s - 604800) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(make_timestamp(end_s * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end,
  strftime(make_timestamp((end_s - 2 * 604800) * 1000000), '%Y-%m-%d %H:%M:%S') AS prev_start,
  oldest_s < end_s - 2 * 604800 + 3600 AS has_previous
FROM bnd"""))
def q_window_bounds(spark, sf_dir):
    ctx = FeedContext(spark, sf_dir)
    b = metrics.window_bounds(ctx.stage()["features"], ctx.window)
    return b.select(*[format_iso(F.col(c)).alias(c) for c in ("newest", "window_start", "window_end", "prev_start")],
                    "has_previous")


@register("sample_volume", cte(_SPINE_SQL, """
SELECT CAST(count(*) AS BIGINT) AS orders FROM feat, bnd
WHERE floor(epoch(ts)) >= end_s - 604800 AND floor(epoch(ts)) < end_s"""))
def q_sample_volume(spark, sf_dir):
    ctx = FeedContext(spark, sf_dir)
    return metrics.sample_volume(ctx.stage()["features"], ctx.window, end=ctx.window_end())


@register("late_flag_rate_over_time", cte(_SPINE_SQL + """,
lk AS (SELECT batch, order_id, arg_min(ts, pos) AS ts FROM feat GROUP BY batch, order_id),
j AS (SELECT p.predicted_late, floor(epoch(lk.ts))::BIGINT AS t FROM pred p JOIN lk USING (batch, order_id)),
r AS (SELECT t // 3600 AS bucket, count(*) AS scored, sum(predicted_late) AS flagged FROM j GROUP BY 1)""", """
SELECT s.slot, strftime(s.bucket_start, '%Y-%m-%d %H:%M:%S') AS bucket_start,
       CAST(coalesce(r.scored, 0) AS BIGINT) AS scored,
       100.0::DOUBLE * r.flagged / r.scored AS flagged_late_pct
FROM spine s LEFT JOIN r USING (bucket)"""))
def q_flag_rate(spark, sf_dir):
    ctx = FeedContext(spark, sf_dir)
    st = ctx.stage()
    r = metrics.late_flag_rate_over_time(st["predictions"], st["features"], ctx.window, end=ctx.window_end(),
                                            unique_keys=True)
    return r.select("slot", format_iso(F.col("bucket_start")).alias("bucket_start"), "scored", "flagged_late_pct")


@register("slot_index", cte(_SPINE_SQL, """
SELECT order_id, batch, ((floor(epoch(ts))::BIGINT - (end_s - 604800)) // 3600) AS slot
FROM feat, bnd WHERE floor(epoch(ts)) >= end_s - 604800 AND floor(epoch(ts)) < end_s"""))
def q_slot_index(spark, sf_dir):
    ctx = FeedContext(spark, sf_dir)
    f = ctx.stage()["features"]
    end_s = metrics.end_epoch(f, ctx.window)
    start_s = end_s - F.lit(ctx.window.window_seconds)
    t = metrics.epoch("timestamp")
    return f.where(metrics.in_window(t, start_s, end_s)).select(
        "order_id", "batch", metrics.slot_index(t, start_s, ctx.window.bucket_seconds).alias("slot"))


@register("score_summary", cte("""
w AS (SELECT * FROM pred)""", """
SELECT CAST(count(*) AS BIGINT) AS n, 100.0::DOUBLE * sum(predicted_late) / count(*) AS flag_rate,
  CAST(sum(CAST(round(late_probability * 1000) AS BIGINT)) AS DOUBLE) / count(*) / 1000.0::DOUBLE AS mean_probability,
  round(quantile_cont(late_probability, 0.1), 6) AS p10, round(quantile_cont(late_probability, 0.5), 6) AS p50,
  round(quantile_cont(late_probability, 0.9), 6) AS p90,
  arg_max(checkpoint_id, CAST(regexp_extract(checkpoint_id, '^model_v(\\d+)$', 1) AS BIGINT)) AS current_checkpoint
FROM w"""))
def q_score_summary(spark, sf_dir):
    s = metrics.score_summary(FeedContext(spark, sf_dir).stage()["predictions"])
    return s.select("n", "flag_rate", "mean_probability", *[F.round(c, 6).alias(c) for c in ("p10", "p50", "p90")],
                    "current_checkpoint")


@register("drop_rate", cte(_SPINE_SQL + """,
k AS (SELECT count(*) AS kept FROM feat, bnd WHERE epoch(batch_time) >= end_s - 604800 AND epoch(batch_time) < end_s),
x AS (SELECT count(*) AS rejected FROM rej, bnd WHERE epoch(batch_time) >= end_s - 604800 AND epoch(batch_time) < end_s)""", """
SELECT CAST(kept AS BIGINT) AS kept, CAST(rejected AS BIGINT) AS rejected,
  CASE WHEN kept + rejected > 0 THEN 100.0::DOUBLE * rejected / (kept + rejected) END AS drop_rate FROM k, x"""))
def q_drop_rate(spark, sf_dir):
    ctx = FeedContext(spark, sf_dir)
    st = ctx.stage()
    return metrics.drop_rate(st["features"], st["rejects"], ctx.window, end=ctx.window_end())


_LABEL_SQL = "CASE reason " + " ".join(
    f"WHEN '{code}' THEN '{label}'" for code, label in __import__("ordersight.options", fromlist=["x"]).REASON_LABELS.items()
) + " ELSE reason END"


@register("failure_counts", cte(_SPINE_SQL + """,
fc AS (SELECT """ + _LABEL_SQL + """ AS label, CAST(count(*) AS BIGINT) AS rows_dropped FROM rej, bnd
       WHERE epoch(batch_time) >= end_s - 604800 AND epoch(batch_time) < end_s GROUP BY 1)""", """
SELECT label, rows_dropped, CAST(row_number() OVER (ORDER BY rows_dropped DESC, label) AS BIGINT) AS rnk,
       round(rows_dropped / sum(rows_dropped) OVER (), 6) AS share FROM fc"""))
def q_failure_counts(spark, sf_dir):
    ctx = FeedContext(spark, sf_dir)
    st = ctx.stage()
    fc = metrics.failure_counts(st["rejects"], st["features"], ctx.window, end=ctx.window_end())
    return fc.withColumn("share", F.round("share", 6))


@register("top_failure", cte(_SPINE_SQL + """,
fc AS (SELECT """ + _LABEL_SQL + """ AS label, CAST(count(*) AS BIGINT) AS rows_dropped FROM rej, bnd
       WHERE epoch(batch_time) >= end_s - 604800 AND epoch(batch_time) < end_s GROUP BY 1)""", """
SELECT label, rows_dropped, round(rows_dropped / sum(rows_dropped) OVER (), 6) AS share
FROM fc QUALIFY row_number() OVER (ORDER BY rows_dropped DESC, label) = 1"""))
def q_top_failure(spark, sf_dir):
    ctx = FeedContext(spark, sf_dir)
    st = ctx.stage()
    fc = metrics.failure_counts(st["rejects"], st["features"], ctx.window, end=ctx.window_end())
    return fc.where(F.col("rnk") == 1).select("label", "rows_dropped", F.round("share", 6).alias("share"))


# ================================================================ KPIs and findings
from ..operators import findings  # noqa: E402

_KPI_CTE = _SPINE_SQL + """,
b2 AS (SELECT end_s, end_s - 604800 AS start_s, end_s - 1209600 AS prev_s,
              oldest_s < end_s - 1209600 + 3600 AS has_previous FROM bnd),
kf AS (SELECT count(*) FILTER (WHERE floor(epoch(ts)) >= start_s AND floor(epoch(ts)) < end_s) AS orders,
              count(*) FILTER (WHERE floor(epoch(ts)) >= prev_s AND floor(epoch(ts)) < start_s) AS prev_orders,
              count(*) FILTER (WHERE epoch(batch_time) >= start_s AND epoch(batch_time) < end_s) AS kept,
              count(*) FILTER (WHERE epoch(batch_time) >= prev_s AND epoch(batch_time) < start_s) AS prev_kept
       FROM feat, b2),
kr AS (SELECT count(*) FILTER (WHERE epoch(batch_time) >= start_s AND epoch(batch_time) < end_s) AS rejected,
              count(*) FILTER (WHERE epoch(batch_time) >= prev_s AND epoch(batch_time) < start_s) AS prev_rejected
       FROM rej, b2),
lk AS (SELECT batch, order_id, arg_min(ts, pos) AS ts FROM feat GROUP BY batch, order_id),
kp AS (SELECT count(*) FILTER (WHERE floor(epoch(lk.ts)) >= start_s AND floor(epoch(lk.ts)) < end_s) AS scored,
              sum(predicted_late) FILTER (WHERE floor(epoch(lk.ts)) >= start_s AND floor(epoch(lk.ts)) < end_s) AS flagged,
              count(*) FILTER (WHERE floor(epoch(lk.ts)) >= prev_s AND floor(epoch(lk.ts)) < start_s) AS prev_scored,
              sum(predicted_late) FILTER (WHERE floor(epoch(lk.ts)) >= prev_s AND floor(epoch(lk.ts)) < start_s) AS prev_flagged
       FROM pred p JOIN lk USING (batch, order_id), b2),
kn AS (SELECT CAST(orders AS BIGINT) AS orders, has_previous,
         CASE WHEN kept + rejected > 0 THEN 100.0::DOUBLE * rejected / (kept + rejected) END AS drop_rate,
         CASE WHEN scored > 0 THEN 100.0::DOUBLE * flagged / scored END AS flag_rate,
         CASE WHEN has_previous THEN prev_orders END AS prev_orders,
         CASE WHEN has_previous AND prev_kept + prev_rejected > 0
              THEN 100.0::DOUBLE * prev_rejected / (prev_kept + prev_rejected) END AS prev_drop_rate,
         CASE WHEN has_previous AND prev_scored > 0 THEN 100.0::DOUBLE * prev_flagged / prev_scored END AS prev_flag_rate
       FROM kf, kr, kp, b2)"""


@register("kpi_deltas", cte(_KPI_CTE, """
SELECT orders, round(drop_rate, 6) AS drop_rate, round(flag_rate, 6) AS flag_rate, has_previous,
  CAST(CASE WHEN has_previous THEN orders - prev_orders END AS BIGINT) AS orders_delta,
  round_even(drop_rate - prev_drop_rate, 1) + 0.0 AS drop_delta_pp,
  round_even(flag_rate - prev_flag_rate, 0) + 0.0 AS flag_delta_pp
FROM kn"""))
def q_kpi_deltas(spark, sf_dir):
    ctx = FeedContext(spark, sf_dir)
    st = ctx.stage()
    k = metrics.kpi_deltas(metrics.kpi_numbers(st["features"], st["rejects"], st["predictions"], ctx.window,
                                                        end=ctx.window_end(), unique_keys=True))
    return k.select("orders", F.round("drop_rate", 6).alias("drop_rate"), F.round("flag_rate", 6).alias("flag_rate"),
                    "has_previous", F.col("orders_delta").cast("long").alias("orders_delta"),
                    "drop_delta_pp", "flag_delta_pp")


@register("kpi_view")
def q_kpi_view(spark, sf_dir):
    """FND-05 with the display strings (STR-05/06); numbers are checked by ``kpi_deltas``."""
    ctx = FeedContext(spark, sf_dir)
    st = ctx.stage()
    return metrics.kpi_deltas(metrics.kpi_numbers(st["features"], st["rejects"], st["predictions"], ctx.window,
                                                        end=ctx.window_end(), unique_keys=True))


_VOL_SERIES_SQL = _SPINE_SQL + """,
c AS (SELECT floor(epoch(ts))::BIGINT // 3600 AS bucket, count(*) AS n FROM feat GROUP BY 1),
vs AS (SELECT s.slot, coalesce(c.n, 0) AS v FROM spine s LEFT JOIN c USING (bucket)),
vf AS (SELECT min(slot) FILTER (WHERE v > 0 AND slot < 167) AS f FROM vs),
va AS (SELECT sum(v) AS total, max(slot) FILTER (WHERE v > 0) AS last_nz,
  count(*) FILTER (WHERE slot > f AND slot < 167) AS hb, sum(v) FILTER (WHERE slot > f AND slot < 167) AS hs,
  count(*) FILTER (WHERE slot > f AND slot < 167 AND slot >= 157) AS rb,
  sum(v) FILTER (WHERE slot > f AND slot < 167 AND slot >= 157) AS rs FROM vs, vf)"""


@register("volume_finding", cte(_VOL_SERIES_SQL, """
SELECT CASE WHEN coalesce(total, 0) = 0 THEN 'none'
            WHEN greatest(0.0, (167 - last_nz) * 60.0) >= 2 THEN 'stalled'
            WHEN hb = 0 OR hs = 0 THEN 'just_started'
            WHEN abs((1.0::DOUBLE * rs / rb) / (1.0::DOUBLE * hs / hb) - 1.0) <= 0.15 + 1e-9 THEN 'steady'
            WHEN (1.0::DOUBLE * rs / rb) / (1.0::DOUBLE * hs / hb) - 1.0 > 0 THEN 'rose' ELSE 'fell' END AS status,
  CAST(total AS BIGINT) AS total, CAST((167 - last_nz) * 60 AS BIGINT) AS trailing_empty_minutes,
  CAST(hb AS BIGINT) AS history_buckets, CAST(rb AS BIGINT) AS recent_buckets,
  round(1.0::DOUBLE * hs / hb, 6) AS baseline_mean, round(1.0::DOUBLE * rs / rb, 6) AS recent_mean,
  round((1.0::DOUBLE * rs / rb) / (1.0::DOUBLE * hs / hb) - 1.0, 6) AS change
FROM va"""))
def q_volume_finding(spark, sf_dir):
    ctx = FeedContext(spark, sf_dir)
    series = metrics.volume_over_time(ctx.stage()["features"], ctx.window, end=ctx.window_end())
    fnd = findings.volume_finding(series, ctx.window.n_buckets, ctx.window.bucket_minutes)
    return fnd.select("status", "total", "trailing_empty_minutes", "history_buckets", "recent_buckets",
                      *[F.round(c, 6).alias(c) for c in ("baseline_mean", "recent_mean", "change")])


_FLAG_SERIES_SQL = _SPINE_SQL + """,
lk AS (SELECT batch, order_id, arg_min(ts, pos) AS ts FROM feat GROUP BY batch, order_id),
r AS (SELECT floor(epoch(lk.ts))::BIGINT // 3600 AS bucket, count(*) AS scored, sum(predicted_late) AS flagged
      FROM pred p JOIN lk USING (batch, order_id) GROUP BY 1),
fs AS (SELECT s.slot, 100.0::DOUBLE * r.flagged / r.scored AS v FROM spine s LEFT JOIN r USING (bucket))"""


@register("flag_finding", cte(_FLAG_SERIES_SQL + """,
fa AS (SELECT count(v) AS n, avg(v) FILTER (WHERE slot >= 158) AS now, count(v) FILTER (WHERE slot >= 158) AS rn,
              avg(v) FILTER (WHERE slot < 158) AS before, count(v) FILTER (WHERE slot < 158) AS en FROM fs)""", """
SELECT CASE WHEN n = 0 THEN 'none' WHEN rn = 0 OR en = 0 THEN 'steady'
            WHEN abs(now - before) >= 5 - 1e-9 THEN CASE WHEN now > before THEN 'more' ELSE 'fewer' END
            ELSE 'steady' END AS status,
  round(now, 6) AS recent_rate, round(before, 6) AS earlier_rate,
  CAST(rn AS BIGINT) AS recent_buckets, CAST(en AS BIGINT) AS earlier_buckets
FROM fa"""))
def q_flag_finding(spark, sf_dir):
    ctx = FeedContext(spark, sf_dir)
    st = ctx.stage()
    series = metrics.late_flag_rate_over_time(st["predictions"], st["features"], ctx.window, end=ctx.window_end(),
                                            unique_keys=True)
    fnd = findings.flag_finding(series, ctx.window.n_buckets)
    return fnd.select("status", F.round("recent_rate", 6).alias("recent_rate"),
                      F.round("earlier_rate", 6).alias("earlier_rate"), "recent_buckets", "earlier_buckets")


@register("failures_finding", cte(_SPINE_SQL + """,
fc AS (SELECT """ + _LABEL_SQL + """ AS label, CAST(count(*) AS BIGINT) AS rows_dropped FROM rej, bnd
       WHERE epoch(batch_time) >= end_s - 604800 AND epoch(batch_time) < end_s GROUP BY 1)""", """
SELECT arg_min(label, (-rows_dropped, label)) AS top_label, max(rows_dropped) AS top_rows,
       CAST(sum(rows_dropped) AS BIGINT) AS rows_dropped_total,
       round(max(rows_dropped) / sum(rows_dropped), 6) AS top_share FROM fc"""))
def q_failures_finding(spark, sf_dir):
    ctx = FeedContext(spark, sf_dir)
    st = ctx.stage()
    fc = metrics.failure_counts(st["rejects"], st["features"], ctx.window, end=ctx.window_end())
    f = findings.failures_finding(fc, ctx.window.window_minutes)
    return f.select("top_label", "top_rows", "rows_dropped_total", F.round("top_share", 6).alias("top_share"))


# the wall clock of the clock check is a parameter (pure and testable); the catalogue pins it
CLOCK_NOW = "2024-01-30 23:50:00"


@register("clock_finding", cte("", """
SELECT """ + _iso_sql("max(ts)") + """ AS newest,
  CASE WHEN max(ts) IS NULL THEN NULL
       WHEN (epoch_us(max(ts)) - epoch_us(TIMESTAMP '""" + CLOCK_NOW + """')) / 60000000.0 > 5 THEN 'clock_ahead'
       ELSE 'ok' END AS status,
  round(greatest(0.0, (epoch_us(TIMESTAMP '""" + CLOCK_NOW + """') - epoch_us(max(ts))) / 60000000.0), 6) AS idle_minutes
FROM feat"""))
def q_clock_finding(spark, sf_dir):
    f = FeedContext(spark, sf_dir).stage()["features"]
    now = F.to_timestamp(F.lit(CLOCK_NOW))
    newest = f.agg(F.max("timestamp").alias("newest"))
    return newest.select(format_iso(F.col("newest")).alias("newest"),
                         findings.clock_finding(F.col("newest"), now).alias("status"),
                         F.round(findings.idle_minutes(F.col("newest"), now), 6).alias("idle_minutes"))


@register("gap_segments", cte(_FLAG_SERIES_SQL, """
SELECT slot, CAST(seg AS BIGINT) AS segment, round(v, 6) AS flagged_late_pct FROM (
  SELECT slot, v, sum(CASE WHEN v IS NULL THEN 1 ELSE 0 END) OVER (ORDER BY slot ROWS UNBOUNDED PRECEDING) AS seg
  FROM fs) WHERE v IS NOT NULL"""))
def q_gap_segments(spark, sf_dir):
    ctx = FeedContext(spark, sf_dir)
    st = ctx.stage()
    series = metrics.late_flag_rate_over_time(st["predictions"], st["features"], ctx.window, end=ctx.window_end(),
                                            unique_keys=True)
    g = findings.gap_segments(series)
    return g.select("slot", "segment", F.round("flagged_late_pct", 6).alias("flagged_late_pct"))


@register("chart_domain", cte(_FLAG_SERIES_SQL + """,
fc AS (SELECT """ + _LABEL_SQL + """ AS label, count(*) AS rows_dropped FROM rej, bnd
       WHERE epoch(batch_time) >= end_s - 604800 AND epoch(batch_time) < end_s GROUP BY 1)""", """
SELECT strftime(make_timestamp((end_s - 604800) * 1000000), '%Y-%m-%d %H:%M:%S') AS domain_start,
       strftime(make_timestamp(end_s * 1000000), '%Y-%m-%d %H:%M:%S') AS domain_end,
       (SELECT CAST(floor(max(rows_dropped) * 1.15) + 1 AS BIGINT) FROM fc) AS x_max,
       (SELECT round(avg(v), 6) FROM fs) AS average_pct
FROM bnd"""))
def q_chart_domain(spark, sf_dir):
    ctx = FeedContext(spark, sf_dir)
    st = ctx.stage()
    series = metrics.late_flag_rate_over_time(st["predictions"], st["features"], ctx.window, end=ctx.window_end(),
                                            unique_keys=True)
    fc = metrics.failure_counts(st["rejects"], st["features"], ctx.window, end=ctx.window_end())
    dom = series.agg(F.min("bucket_start").alias("s"), F.max("bucket_start").alias("e"),
                     F.round(F.avg("flagged_late_pct"), 6).alias("average_pct"))   # AGG-25
    return dom.select(format_iso(F.col("s")).alias("domain_start"),
                      format_iso(F.col("e") + F.expr(f"INTERVAL {ctx.window.bucket_seconds} SECONDS")).alias("domain_end"),
                      findings.bar_domain(fc).select("x_max").scalar().alias("x_max"), "average_pct")


@register("volume_finding_by_peak", cte(_SPINE_SQL + """,
ks AS (SELECT DISTINCT is_peak FROM feat),
c AS (SELECT is_peak, floor(epoch(ts))::BIGINT // 3600 AS bucket, count(*) AS n FROM feat GROUP BY 1, 2),
vs AS (SELECT ks.is_peak, s.slot, coalesce(c.n, 0) AS v FROM ks CROSS JOIN spine s
       LEFT JOIN c ON c.is_peak = ks.is_peak AND c.bucket = s.bucket),
vf AS (SELECT is_peak, min(slot) FILTER (WHERE v > 0 AND slot < 167) AS f FROM vs GROUP BY 1),
va AS (SELECT is_peak, sum(v) AS total, max(slot) FILTER (WHERE v > 0) AS last_nz,
  count(*) FILTER (WHERE slot > f AND slot < 167) AS hb, sum(v) FILTER (WHERE slot > f AND slot < 167) AS hs,
  count(*) FILTER (WHERE slot > f AND slot < 167 AND slot >= 157) AS rb,
  sum(v) FILTER (WHERE slot > f AND slot < 167 AND slot >= 157) AS rs FROM vs JOIN vf USING (is_peak) GROUP BY 1)""", """
SELECT is_peak, CASE WHEN coalesce(total, 0) = 0 THEN 'none'
            WHEN greatest(0.0, (167 - last_nz) * 60.0) >= 2 THEN 'stalled'
            WHEN hb = 0 OR hs = 0 THEN 'just_started'
            WHEN abs((1.0::DOUBLE * rs / rb) / (1.0::DOUBLE * hs / hb) - 1.0) <= 0.15 + 1e-9 THEN 'steady'
            WHEN (1.0::DOUBLE * rs / rb) / (1.0::DOUBLE * hs / hb) - 1.0 > 0 THEN 'rose' ELSE 'fell' END AS status,
  CAST(total AS BIGINT) AS total, CAST((167 - last_nz) * 60 AS BIGINT) AS trailing_empty_minutes
FROM va"""))
def q_volume_finding_by_peak(spark, sf_dir):
    ctx = FeedContext(spark, sf_dir)
    series = metrics.volume_over_time_by(ctx.stage()["features"], ctx.window, ["is_peak"], end=ctx.window_end())
    fnd = findings.volume_finding(series, ctx.window.n_buckets, ctx.window.bucket_minutes, keys=["is_peak"])
    return fnd.select("is_peak", "status", "total", "trailing_empty_minutes")


@register("flag_finding_by_peak", cte(_SPINE_SQL + """,
ks AS (SELECT DISTINCT is_peak FROM feat),
lk AS (SELECT batch, order_id, arg_min(ts, pos) AS ts, arg_min(is_peak, pos) AS is_peak FROM feat GROUP BY batch, order_id),
r AS (SELECT lk.is_peak, floor(epoch(lk.ts))::BIGINT // 3600 AS bucket, count(*) AS scored, sum(predicted_late) AS flagged
      FROM pred p JOIN lk USING (batch, order_id) GROUP BY 1, 2),
fs AS (SELECT ks.is_peak, s.slot, 100.0::DOUBLE * r.flagged / r.scored AS v FROM ks CROSS JOIN spine s
       LEFT JOIN r ON r.is_peak = ks.is_peak AND r.bucket = s.bucket),
fa AS (SELECT is_peak, count(v) AS n, avg(v) FILTER (WHERE slot >= 158) AS now, count(v) FILTER (WHERE slot >= 158) AS rn,
              avg(v) FILTER (WHERE slot < 158) AS before, count(v) FILTER (WHERE slot < 158) AS en FROM fs GROUP BY 1)""", """
SELECT is_peak, CASE WHEN n = 0 THEN 'none' WHEN rn = 0 OR en = 0 THEN 'steady'
            WHEN abs(now - before) >= 5 - 1e-9 THEN CASE WHEN now > before THEN 'more' ELSE 'fewer' END
            ELSE 'steady' END AS status,
  CAST(rn AS BIGINT) AS recent_buckets, CAST(en AS BIGINT) AS earlier_buckets
FROM fa"""))
def q_flag_finding_by_peak(spark, sf_dir):
    ctx = FeedContext(spark, sf_dir)
    st = ctx.stage()
    series = metrics.late_flag_rate_over_time_by(st["predictions"], st["features"], ctx.window, ["is_peak"],
                                                 end=ctx.window_end(), unique_keys=True)
    fnd = findings.flag_finding(series, ctx.window.n_buckets, keys=["is_peak"])
    return fnd.select("is_peak", "status", "recent_buckets", "earlier_buckets")


# ================================================================ training, registry, ledger
from ..operators import registry, training  # noqa: E402
from ..options import TrainOptions  # noqa: E402

_SPLIT_CTE = """
sz AS (SELECT count(*) AS n, count(*) - greatest(1, round_even(0.2 * count(*), 0)) AS n_train FROM feat),
sp AS (SELECT f.*, row_number() OVER (ORDER BY batch, pos) - 1 AS position FROM feat f)"""


@register("holdout_split", cte(_SPLIT_CTE, """
SELECT batch, pos, CASE WHEN position < (SELECT n_train FROM sz) THEN 'train' ELSE 'test' END AS split FROM sp"""))
def q_holdout_split(spark, sf_dir):
    f, cut = _holdout(spark, sf_dir)
    return training.holdout_split(f, cutoff=cut).select("batch", "pos", "split")


_CUTOFFS: dict[str, tuple] = {}


def _holdout(spark, sf_dir):
    """Stage features and their holdout cutoff, found once per stage table (two scalars)."""
    ctx = FeedContext(spark, sf_dir)
    f = ctx.stage()["features"]
    root = ctx.stage_dir()
    if root not in _CUTOFFS:
        _CUTOFFS[root] = training.holdout_cutoff(f)
    return f, _CUTOFFS[root]


_GOLDEN_P_SQL = "1.0 / (1.0 + exp(-(-7.0 + 0.6 * distance_km + 0.25 * prep_minutes)))"


#: Counts, and the rank sum of distinct scores, of the scored test rows ``te (y, p)``.
_METRICS_CTE = """
c AS (SELECT count(*) AS n, sum(y) AS pos, sum(CASE WHEN p > 0.5 AND y = 1 THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN p > 0.5 AND y = 0 THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN p <= 0.5 AND y = 1 THEN 1 ELSE 0 END) AS fn,
             sum(CASE WHEN (p > 0.5) = (y = 1) THEN 1 ELSE 0 END) AS correct FROM te),
h AS (SELECT p AS s, sum(y) AS ps, sum(1 - y) AS qs FROM te GROUP BY p),
hr AS (SELECT ps, qs, coalesce(sum(qs) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS qb FROM h),
a AS (SELECT CASE WHEN sum(ps) > 0 AND sum(qs) > 0
                  THEN CAST(sum(ps * (2 * qb + qs)) AS DOUBLE) / (2.0 * sum(ps) * sum(qs)) END AS auc FROM hr)"""
_METRICS_SQL = """CAST(n AS BIGINT) AS n_test, round_even(CAST(pos AS DOUBLE) / n, 3) AS late_rate_test,
  round_even(greatest(CAST(pos AS DOUBLE) / n, 1.0 - CAST(pos AS DOUBLE) / n), 3) AS baseline_accuracy,
  round_even(CAST(correct AS DOUBLE) / n, 3) AS accuracy,
  round_even(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0), 3) AS precision,
  round_even(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0), 3) AS recall,
  round_even(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0), 3) AS f1,
  round_even(auc, 3) AS roc_auc"""


@register("holdout_metrics_fixed", cte(_SPLIT_CTE + """,
te AS (SELECT was_late AS y, """ + _GOLDEN_P_SQL + """ AS p FROM sp WHERE position >= (SELECT n_train FROM sz)),""" + _METRICS_CTE,
                                       "SELECT " + _METRICS_SQL + " FROM c, a"))
def q_holdout_metrics_fixed(spark, sf_dir):
    f, cut = _holdout(spark, sf_dir)
    test = f.where(training.split_side(cut, "test")).withColumn(
        "probability", scoring.logistic(scoring.GOLDEN_COEFFICIENTS, scoring.GOLDEN_INTERCEPT))
    m = training.classification_metrics(test)
    return m.select("n_test", *[F.bround(c, 3).alias(c) for c in m.columns if c != "n_test"])


# Newton steps over the distinct training rows: gradient g, Hessian h (both with the penalty), solved by determinants
_FIT_CTE = _SPLIT_CTE + """,
cp AS MATERIALIZED (SELECT distance_km AS x1, CAST(prep_minutes AS DOUBLE) AS x2, CAST(was_late AS DOUBLE) AS y, CAST(count(*) AS DOUBLE) AS w
  FROM sp WHERE position < (SELECT n_train FROM sz) GROUP BY 1, 2, 3),
nw AS (
  SELECT 0 AS it, CAST(0 AS DOUBLE) AS b0, CAST(0 AS DOUBLE) AS b1, CAST(0 AS DOUBLE) AS b2
  UNION ALL
  SELECT it + 1,
    b0 - (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / d,
    b1 - (h00 * (g1 * h22 - g2 * h12) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / d,
    b2 - (h00 * (h11 * g2 - h12 * g1) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / d
  FROM (SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS d
    FROM (SELECT it, b0, b1, b2, sum(w * (p - y)) AS g0, sum(w * (p - y) * x1) + b1 AS g1, sum(w * (p - y) * x2) + b2 AS g2,
        sum(w * q) AS h00, sum(w * q * x1) AS h01, sum(w * q * x2) AS h02, sum(w * q * x1 * x1) + 1 AS h11,
        sum(w * q * x1 * x2) AS h12, sum(w * q * x2 * x2) + 1 AS h22
      FROM (SELECT *, p * (1 - p) AS q FROM (SELECT *, 1.0 / (1.0 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM nw, cp))
      GROUP BY it, b0, b1, b2))
  WHERE it < 20),
fw AS (SELECT b0, b1, b2 FROM nw WHERE it = 20)"""
_FITTED_P_SQL = "1.0 / (1.0 + exp(-(b0 + b1 * distance_km + b2 * prep_minutes)))"


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@register("fit_logistic", _recursive(cte(_FIT_CTE + """,
te AS (SELECT was_late AS y, """ + _FITTED_P_SQL + """ AS p FROM sp, fw WHERE position >= (SELECT n_train FROM sz)),""" + _METRICS_CTE + """,
mt AS (SELECT """ + _METRICS_SQL + """ FROM c, a)""", """
SELECT CAST(1 AS BIGINT) AS version, 'model_v0001' AS model_file, 'LogisticRegression' AS model_type,
  'distance_km,prep_minutes' AS feature_columns, 'was_late' AS label_column, '2024-01-31T00:00:00Z' AS trained_at,
  CAST(n AS BIGINT) AS rows_total, CAST(n AS BIGINT) AS rows_new, CAST(n_train AS BIGINT) AS n_train, n_test,
  (SELECT strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') FROM feat) AS data_through,
  late_rate_test, baseline_accuracy, accuracy, precision, recall, f1, roc_auc,
  round(b1, 3) AS weight_distance_km, round(b2, 3) AS weight_prep_minutes, round(b0, 3) AS intercept,
  CAST(400 AS BIGINT) AS train_every_n_events
FROM sz, mt, fw""")))
def q_fit_logistic(spark, sf_dir):
    """ML-02/03/05/07, MAP-01: fit on the oldest 80 %, evaluate on the newest 20 %; one registry row, a column per weight."""
    f, cut = _holdout(spark, sf_dir)
    opts = TrainOptions()
    status, fit, m, sizes = training.train_once(f, opts, cutoff=cut)
    if status != "ready":
        raise ValueError(f"not ready: {status}")
    rec = training.registry_record(fit, m, sizes["rows_total"], sizes["rows_total"], sizes["n_test"],
                                   sizes["data_through"], "2024-01-31T00:00:00Z", opts)
    row = registry.records_frame(spark, [{**rec, "version": 1, "model_file": "model_v0001"}])
    return row.withColumns({f"weight_{c}": F.col("coefficients")[c] for c in opts.features}
                           | {"feature_columns": F.array_join("feature_columns", ",")}).drop("coefficients")


@register("fit_and_score", _recursive(cte(_FIT_CTE, """
SELECT order_id, round(p, 3) AS late_probability, CAST(round(p, 3) >= 0.5 AS INTEGER) AS predicted_late,
  'model_v0001' AS checkpoint_id, batch, pos
FROM (SELECT f.*, """ + _FITTED_P_SQL + """ AS p FROM feat f, fw)""")))
def q_fit_and_score(spark, sf_dir):
    """ML-02/03/08/10, UDF-02: fit on the holdout's train part, then score every kept order with it.

    The fitted model is a few coefficients, so scoring stays a codegen'd column
    expression built from the model's own feature list.
    """
    f, cut = _holdout(spark, sf_dir)
    status, fit, _, _ = training.train_once(f, TrainOptions(), cutoff=cut)
    if status != "ready":
        raise ValueError(f"not ready: {status}")
    return scoring.score_fixed(f, fit.coefficients, fit.intercept, "model_v0001")


@register("model_registry_history", cte("""
pd AS (SELECT floor(epoch(batch_time) / 86400)::BIGINT AS period, count(*) AS rows, max(ts) AS newest FROM feat GROUP BY 1),
rg AS (SELECT row_number() OVER (ORDER BY period) AS version, period,
              sum(rows) OVER (ORDER BY period ROWS UNBOUNDED PRECEDING) AS rows_total,
              max(newest) OVER (ORDER BY period ROWS UNBOUNDED PRECEDING) AS data_through FROM pd)""", """
SELECT CAST(version AS BIGINT) AS version, 'model_v' || lpad(CAST(version AS VARCHAR), 4, '0') AS checkpoint_id,
  strftime(make_timestamp((period + 1) * 86400 * 1000000), '%Y-%m-%d %H:%M:%S') AS trained_at,
  """ + _iso_sql("data_through") + """ AS data_through, CAST(rows_total AS BIGINT) AS rows_total,
  CAST(rows_total - coalesce(lag(rows_total) OVER (ORDER BY version), 0) AS BIGINT) AS rows_new,
  rows_total - coalesce(lag(rows_total) OVER (ORDER BY version), 0) >= 400 AS retrain_due
FROM rg"""))
def q_registry_history(spark, sf_dir):
    f = FeedContext(spark, sf_dir).stage()["features"]
    r = registry.schedule_registry(f)
    return r.select("version", "checkpoint_id", format_iso(F.col("trained_at")).alias("trained_at"),
                    format_iso(F.col("data_through")).alias("data_through"), "rows_total", "rows_new", "retrain_due")


@register("newest_model", cte("""
pd AS (SELECT DISTINCT floor(epoch(batch_time) / 86400)::BIGINT AS period FROM feat)""", """
SELECT CAST(count(*) AS BIGINT) AS version, 'model_v' || lpad(CAST(count(*) AS VARCHAR), 4, '0') AS checkpoint_id FROM pd"""))
def q_newest_model(spark, sf_dir):
    f = FeedContext(spark, sf_dir).stage()["features"]
    return registry.newest(registry.schedule_registry(f))


@register("next_version", cte("""
pd AS (SELECT DISTINCT floor(epoch(batch_time) / 86400)::BIGINT AS period FROM feat)""", """
SELECT CAST(count(*) + 1 AS BIGINT) AS next_version FROM pd"""))
def q_next_version(spark, sf_dir):
    f = FeedContext(spark, sf_dir).stage()["features"]
    return registry.next_version(registry.schedule_registry(f))


@register("rows_available", cte(BATCH_STATS_CTE, """
SELECT CAST(sum(kept) AS BIGINT) AS rows_available, CAST(count(*) AS BIGINT) AS batches FROM bs"""))
def q_rows_available(spark, sf_dir):
    st = FeedContext(spark, sf_dir).stage()["batch_stats"]
    return st.agg(F.sum("kept").cast("long").alias("rows_available"), F.count(F.lit(1)).cast("long").alias("batches"))


@register("data_through", cte("", """
SELECT """ + _iso_sql("max(ts)") + """ AS newest, """ + _iso_sql("min(ts)") + """ AS oldest FROM feat"""))
def q_data_through(spark, sf_dir):
    f = FeedContext(spark, sf_dir).stage()["features"]
    return f.agg(format_iso(F.max("timestamp")).alias("newest"), format_iso(F.min("timestamp")).alias("oldest"))


# the first run's ledger: batches processed before this stamp (a job parameter)
LEDGER_CUTOFF = "20240115T000000Z"


@register("pending_batches", cte(BATCH_STATS_CTE, """
SELECT DISTINCT r.batch FROM raw r
WHERE NOT EXISTS (SELECT 1 FROM bs WHERE bs.batch = r.batch AND bs.batch < '""" + LEDGER_CUTOFF + """')"""))
def q_pending_batches(spark, sf_dir):
    from ..operators import ledger
    ctx = FeedContext(spark, sf_dir)
    done = ctx.stage()["batch_stats"].where(F.col("batch") < LEDGER_CUTOFF)
    return ledger.pending(ctx.raw().select("batch"), done)


# second model of the hot-swap query: (distance, prep, intercept)
SECOND_MODEL = ({"distance_km": 0.55, "prep_minutes": 0.3}, -7.2)
SWAP_AT = "2024-01-16 00:00:00"


@register("scores_two_versions", cte("""
sc AS (SELECT CASE WHEN batch_time < TIMESTAMP '""" + SWAP_AT + """' THEN 'model_v0001' ELSE 'model_v0002' END AS checkpoint_id,
  round(CASE WHEN batch_time < TIMESTAMP '""" + SWAP_AT + """'
             THEN 1.0 / (1.0 + exp(-(-7.0 + 0.6 * distance_km + 0.25 * prep_minutes)))
             ELSE 1.0 / (1.0 + exp(-(-7.2 + 0.55 * distance_km + 0.3 * prep_minutes))) END, 3) AS p FROM feat)""", """
SELECT checkpoint_id, CAST(regexp_extract(checkpoint_id, '^model_v(\\d+)$', 1) AS BIGINT) AS version,
  CAST(count(*) AS BIGINT) AS rows, CAST(sum(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS flagged,
  max(checkpoint_id) OVER () AS current_checkpoint
FROM sc GROUP BY checkpoint_id"""))
def q_scores_two_versions(spark, sf_dir):
    f = FeedContext(spark, sf_dir).stage()["features"]
    coefs, icpt = SECOND_MODEL
    models = spark.createDataFrame(
        [(1, scoring.GOLDEN_INTERCEPT, scoring.GOLDEN_COEFFICIENTS), (2, icpt, coefs)],
        "version long, intercept double, coefficients map<string,double>")
    version = F.when(F.col("batch_time") < F.to_timestamp(F.lit(SWAP_AT)), F.lit(1)).otherwise(F.lit(2)).cast("long")
    preds = scoring.score_by_version(f, models, version)
    per = metrics.rows_per_checkpoint(preds.withColumn("_f", F.col("predicted_late"))) \
        .join(preds.groupBy("checkpoint_id").agg(F.sum("predicted_late").cast("long").alias("flagged")), "checkpoint_id")
    current = metrics.score_summary(preds).select("current_checkpoint").scalar()
    return per.select("checkpoint_id", "version", "rows", "flagged", current.alias("current_checkpoint"))


# ================================================================ streaming
from ..streaming import committed, jobs  # noqa: E402
from ..sources.feed import order_feed  # noqa: E402
from ..sources.tables import table  # noqa: E402


def _events_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    # the pattern names the table alone, be it one file or a folder of part files
    return spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")


def _stream_root(ctx: FeedContext, name: str) -> str:
    import uuid
    return f"{ctx.stage_dir()}/streams/{name}-{uuid.uuid4().hex[:8]}"


def _run_clean_stream(spark, sf_dir) -> str:
    ctx = FeedContext(spark, sf_dir)
    root = _stream_root(ctx, "clean")
    from ..sources.tables import spread as _spread
    q = jobs.clean_stream(_events_stream(spark, sf_dir), lambda b: order_feed(_spread(b)), root, f"{root}/_checkpoint",
                          ctx.quality, skip_blank=False)
    q.awaitTermination()
    return root


@register("stream_clean", ORACLE["features"])
def q_stream_clean(spark, sf_dir):
    """ST-01/05/06/14: the cleaning job as an availableNow stream over the events table."""
    root = _run_clean_stream(spark, sf_dir)
    f = jobs.stream_outputs(spark, root)["features"]
    return f.select("order_id", format_iso(F.col("timestamp")).alias("timestamp"), "hour", "is_peak",
                    "distance_km", "prep_minutes", "order_value", "was_late", "batch",
                    format_iso(F.col("batch_time")).alias("batch_time"), "pos")


@register("stream_score", ORACLE["predictions_fixed"])
def q_stream_score(spark, sf_dir):
    """ST-03: committed epochs of the cleaning job scored with the model chosen at the time."""
    root = _run_clean_stream(spark, sf_dir)

    def newest_model():
        return scoring.GOLDEN_COEFFICIENTS, scoring.GOLDEN_INTERCEPT, "model_v0001"

    committed.score_stream(spark, root, newest_model, f"{root}/_score_checkpoint").awaitTermination()
    p = committed.predictions(spark, root)
    return p.select("order_id", "late_probability", "predicted_late", "checkpoint_id", "batch", "pos")


@register("stream_volume", ORACLE["volume_over_time"])
def q_stream_volume(spark, sf_dir):
    """ST-04/09/11: per-bucket counts of committed epochs maintained by a stream, window queried from them."""
    ctx = FeedContext(spark, sf_dir)
    root = _run_clean_stream(spark, sf_dir)
    committed.volume_stream(spark, root, ctx.window, f"{root}/_volume_checkpoint").awaitTermination()
    per_bucket = committed.bucket_counts(spark, root)
    sp = metrics.bucket_spine(per_bucket, ctx.window, weight="orders")
    return sp.join(per_bucket, "bucket", "left").select(
        "slot", format_iso(F.col("bucket_start")).alias("bucket_start"),
        F.coalesce("orders", F.lit(0)).cast("long").alias("orders"))


# ================================================================ guards and the whole view
from ..operators import guards  # noqa: E402


@register("training_scan_guard", cte("""
g AS (SELECT batch, pos,
  regexp_full_match(trim(distance_km), '[+-]?(\\d+(\\.\\d*)?|\\.\\d+)([eE][+-]?\\d+)?') AND isfinite(TRY_CAST(trim(distance_km) AS DOUBLE))
  AND regexp_full_match(trim(prep_minutes), '[+-]?(\\d+(\\.\\d*)?|\\.\\d+)([eE][+-]?\\d+)?') AND isfinite(TRY_CAST(trim(prep_minutes) AS DOUBLE))
  AND was_late IN ('0', '1') AS ok FROM raw)""", """
SELECT batch, CAST(count(*) AS BIGINT) AS rows, min(pos) FILTER (WHERE NOT ok) IS NULL AS usable,
       min(pos) FILTER (WHERE NOT ok) AS first_bad_pos
FROM g GROUP BY batch"""))
def q_training_scan_guard(spark, sf_dir):
    """SRC-07/FLT-11: which raw batches a training scan would accept whole (one bad row skips the batch)."""
    raw = quality.parse_raw(FeedContext(spark, sf_dir).raw(), skip_blank=False)
    ok = guards.usable_training_row(F.coalesce("distance_km", F.lit("")), F.coalesce("prep_minutes", F.lit("")),
                                    F.coalesce("was_late", F.lit("")))
    return guards.batch_guard(raw, ok, "unusable row").select("batch", "rows", "usable", "first_bad_pos")


@register("pulse_view")
def q_pulse_view(spark, sf_dir):
    """FND-06: the composed view's summary row (every number in it is oracle-checked elsewhere)."""
    from .view import pulse_view
    from ..operators import registry as _reg
    ctx = FeedContext(spark, sf_dir)
    st = ctx.stage()
    v = pulse_view(st["features"], st["rejects"], st["predictions"], ctx.window,
                   F.to_timestamp(F.lit(CLOCK_NOW)), _reg.newest(_reg.schedule_registry(st["features"])),
                   end=ctx.window_end(), unique_keys=True)
    return v.summary


# ================================================================ ledger and export text
from ..operators import ledger as _ledger  # noqa: E402

RUN_STARTED = "2024-01-23 00:00:00"   # the run boundary for "new batches" (a job parameter)


@register("batch_ledger", cte(BATCH_STATS_CTE + """,
bt AS (SELECT DISTINCT batch, batch_time FROM raw)""", """
SELECT bs.batch, 'clean' AS stage, rows_in, kept, rejected, 'committed' AS status,
  """ + _REASON_TEXT_SQL + """ AS reasons_text,
  strftime(bt.batch_time + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS committed_at
FROM bs JOIN bt USING (batch)"""))
def q_batch_ledger(spark, sf_dir):
    """SNK-05: one committed ledger row per batch (the batch closes one hour after its stamp)."""
    ctx = FeedContext(spark, sf_dir)
    st = ctx.stage()
    stats = st["batch_stats"]
    closes = ctx.raw().select("batch", "batch_time").distinct()
    led = _ledger.ledger_rows(stats.join(closes, "batch"), "clean",
                              committed_at=F.col("batch_time") + F.expr("INTERVAL 1 HOUR"))
    text = F.array_join(F.transform(
        F.filter(F.array(*[F.struct(F.lit(r).alias("k"), F.col("reasons")[r].alias("v")) for r in REJECT_REASONS]),
                 lambda x: x["v"].isNotNull()),
        lambda x: F.concat(x["k"], F.lit(" "), x["v"].cast("string"))), ", ")
    return led.select("batch", "stage", "rows_in", "kept", "rejected", "status", text.alias("reasons_text"),
                      format_iso(F.col("committed_at")).alias("committed_at"))


@register("ledger_counts", cte("""
bt AS (SELECT DISTINCT batch, batch_time FROM raw)""", """
SELECT 'clean' AS stage, CAST(count(*) AS BIGINT) AS batches,
  CAST(count(*) FILTER (WHERE batch_time + INTERVAL 1 HOUR >= TIMESTAMP '""" + RUN_STARTED + """') AS BIGINT) AS new_batches
FROM bt"""))
def q_ledger_counts(spark, sf_dir):
    """AGG-23: committed batches per stage and how many were first seen in this run."""
    ctx = FeedContext(spark, sf_dir)
    stats = ctx.stage()["batch_stats"].join(ctx.raw().select("batch", "batch_time").distinct(), "batch")
    led = _ledger.ledger_rows(stats, "clean", committed_at=F.col("batch_time") + F.expr("INTERVAL 1 HOUR"))
    return _ledger.folder_counts(led, RUN_STARTED)


@register("features_export_text", cte("", """
SELECT order_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, CAST(hour AS VARCHAR) AS hour,
  CAST(is_peak AS VARCHAR) AS is_peak, printf('%.1f', distance_km) AS distance_km,
  CAST(prep_minutes AS VARCHAR) AS prep_minutes, printf('%.2f', order_value) AS order_value,
  CAST(was_late AS VARCHAR) AS was_late, batch, pos FROM feat"""))
def q_features_export_text(spark, sf_dir):
    """PRJ-02/SNK-02: the canonical text rendering of feature rows (what the CSV export writes)."""
    return quality.features_for_export(FeedContext(spark, sf_dir).stage()["features"])


# the golden model's data_through: batches stamped after it are unseen by the model
GOLDEN_DATA_THROUGH = "2024-01-16 00:00:00"


@register("post_hoc_accuracy", cte("", """
SELECT p.checkpoint_id, f.batch_time > TIMESTAMP '""" + GOLDEN_DATA_THROUGH + """' AS unseen,
  CAST(count(*) AS BIGINT) AS scored, CAST(sum(CASE WHEN p.predicted_late = f.was_late THEN 1 ELSE 0 END) AS BIGINT) AS correct,
  round(CAST(sum(CASE WHEN p.predicted_late = f.was_late THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6) AS accuracy
FROM pred p JOIN feat f ON p.batch = f.batch AND p.order_id = f.order_id GROUP BY 1, 2"""))
def q_post_hoc_accuracy(spark, sf_dir):
    """JN-08: predictions joined to the actual labels; only batches after the model's data_through are unseen."""
    st = FeedContext(spark, sf_dir).stage()
    actual = st["features"].select("batch", "order_id", "was_late", F.col("batch_time").alias("_bt"))
    j = st["predictions"].join(actual, ["batch", "order_id"])
    unseen = F.col("_bt") > F.to_timestamp(F.lit(GOLDEN_DATA_THROUGH))
    ok = (F.col("predicted_late") == F.col("was_late")).cast("long")
    return j.groupBy("checkpoint_id", unseen.alias("unseen")).agg(
        F.count(F.lit(1)).cast("long").alias("scored"), F.sum(ok).cast("long").alias("correct")) \
        .withColumn("accuracy", F.round(F.col("correct") / F.col("scored"), 6))


def _with_event_type(spark, sf_dir, feats):
    """Enrich feature rows with the originating event's type (pos is the event id): a big-to-big
    equi-join left to AQE (sort-merge at scale, skew-split if one id is hot)."""
    ev = table(spark, sf_dir, "events").select(F.col("event_id").alias("pos"), "event_type")
    return feats.join(ev, "pos", "inner")


@register("volume_finding_by_event_type", cte(_SPINE_SQL + """,
fe AS (SELECT f.*, e.event_type FROM feat f JOIN events e ON f.pos = e.event_id),
ks AS (SELECT DISTINCT event_type FROM fe),
c AS (SELECT event_type, floor(epoch(ts))::BIGINT // 3600 AS bucket, count(*) AS n FROM fe GROUP BY 1, 2),
vs AS (SELECT ks.event_type, s.slot, coalesce(c.n, 0) AS v FROM ks CROSS JOIN spine s
       LEFT JOIN c ON c.event_type = ks.event_type AND c.bucket = s.bucket),
vf AS (SELECT event_type, min(slot) FILTER (WHERE v > 0 AND slot < 167) AS f FROM vs GROUP BY 1),
va AS (SELECT event_type, sum(v) AS total, max(slot) FILTER (WHERE v > 0) AS last_nz,
  count(*) FILTER (WHERE slot > f AND slot < 167) AS hb, sum(v) FILTER (WHERE slot > f AND slot < 167) AS hs,
  count(*) FILTER (WHERE slot > f AND slot < 167 AND slot >= 157) AS rb,
  sum(v) FILTER (WHERE slot > f AND slot < 167 AND slot >= 157) AS rs FROM vs JOIN vf USING (event_type) GROUP BY 1)""", """
SELECT event_type, CASE WHEN coalesce(total, 0) = 0 THEN 'none'
            WHEN greatest(0.0, (167 - last_nz) * 60.0) >= 2 THEN 'stalled'
            WHEN hb = 0 OR hs = 0 THEN 'just_started'
            WHEN abs((1.0::DOUBLE * rs / rb) / (1.0::DOUBLE * hs / hb) - 1.0) <= 0.15 + 1e-9 THEN 'steady'
            WHEN (1.0::DOUBLE * rs / rb) / (1.0::DOUBLE * hs / hb) - 1.0 > 0 THEN 'rose' ELSE 'fell' END AS status,
  CAST(total AS BIGINT) AS total, CAST((167 - last_nz) * 60 AS BIGINT) AS trailing_empty_minutes,
  round((1.0::DOUBLE * rs / rb) / (1.0::DOUBLE * hs / hb) - 1.0, 6) AS change
FROM va"""))
def q_volume_finding_by_event_type(spark, sf_dir):
    """FND-01 for many series at once: one volume trend per event type (shared anchored window)."""
    ctx = FeedContext(spark, sf_dir)
    f = _with_event_type(spark, sf_dir, ctx.stage()["features"])
    series = metrics.volume_over_time_by(f, ctx.window, ["event_type"])
    fnd = findings.volume_finding(series, ctx.window.n_buckets, ctx.window.bucket_minutes, keys=["event_type"])
    return fnd.select("event_type", "status", "total", "trailing_empty_minutes", F.round("change", 6).alias("change"))


@register("flag_finding_by_event_type", cte(_SPINE_SQL + """,
fe AS (SELECT f.*, e.event_type FROM feat f JOIN events e ON f.pos = e.event_id),
ks AS (SELECT DISTINCT event_type FROM fe),
lk AS (SELECT batch, order_id, arg_min(ts, pos) AS ts, arg_min(event_type, pos) AS event_type FROM fe GROUP BY batch, order_id),
r AS (SELECT lk.event_type, floor(epoch(lk.ts))::BIGINT // 3600 AS bucket, count(*) AS scored, sum(predicted_late) AS flagged
      FROM pred p JOIN lk USING (batch, order_id) GROUP BY 1, 2),
fs AS (SELECT ks.event_type, s.slot, 100.0::DOUBLE * r.flagged / r.scored AS v FROM ks CROSS JOIN spine s
       LEFT JOIN r ON r.event_type = ks.event_type AND r.bucket = s.bucket),
fa AS (SELECT event_type, count(v) AS n, count(v) FILTER (WHERE slot >= 158) AS rn,
              count(v) FILTER (WHERE slot < 158) AS en,
              avg(v) FILTER (WHERE slot >= 158) AS now, avg(v) FILTER (WHERE slot < 158) AS before FROM fs GROUP BY 1)""", """
SELECT event_type, CASE WHEN n = 0 THEN 'none' WHEN rn = 0 OR en = 0 THEN 'steady'
            WHEN abs(now - before) >= 5 - 1e-9 THEN CASE WHEN now > before THEN 'more' ELSE 'fewer' END
            ELSE 'steady' END AS status,
  CAST(rn AS BIGINT) AS recent_buckets, CAST(en AS BIGINT) AS earlier_buckets
FROM fa"""))
def q_flag_finding_by_event_type(spark, sf_dir):
    """FND-02 per event type: flag-rate trend of each segment's predictions."""
    ctx = FeedContext(spark, sf_dir)
    st = ctx.stage()
    f = _with_event_type(spark, sf_dir, st["features"])
    series = metrics.late_flag_rate_over_time_by(st["predictions"], f, ctx.window, ["event_type"])
    fnd = findings.flag_finding(series, ctx.window.n_buckets, keys=["event_type"])
    return fnd.select("event_type", "status", "recent_buckets", "earlier_buckets")
