"""Feed adapter: deterministic, deliberately dirty raw order lines derived from ``events``.

The driver supplies an ``events`` table but no order feed.  This adapter projects
every event into one raw CSV line of an order batch (hourly batches), using only
integer arithmetic and string functions, so the same feed can be rebuilt by any
SQL engine (the DuckDB oracle does exactly that) and its work grows with the
table.  The output has the shape of the raw text source: ``batch``,
``batch_time``, ``pos`` (order within the batch file) and ``raw_line``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..options import PEAK_HOURS

# Fixed values of the adapter (shared with the DuckDB oracle in plans/catalog.py).
FEED_BATCH_SEQ = "_0001"
LATE_THRESHOLD = 400      # tenths of a minute: prep + 3*km + noise (+8 at peak) > 40
PEAK_DELAY = 80           # tenths


def _m(e: Column, mod: int, rest: int) -> Column:
    return (e % mod) == rest


def feed_fields(events: DataFrame) -> DataFrame:
    """One row per event with the six raw text fields, the field count and the true label."""
    e = F.col("event_id")
    ts = F.col("ts")                      # TIMESTAMP_NTZ: formatting is clock independent
    # the numbers the text fields are built from, computed once per row (JSON read once)
    base = events.select(
        e.alias("event_id"), ts.alias("ts"),
        F.get_json_object("props", "$.k").cast("long").alias("_k"),
        F.date_trunc("hour", ts).alias("_hour_start"),
        F.hour(ts).isin(*PEAK_HOURS).alias("_peak"),
        F.floor(F.col("value") * 100 + F.lit(0.5)).cast("long").alias("_cents"))
    base = base.select("*", (F.lit(5) + (e * 7919) % 146).alias("_d10"), (F.lit(5) + F.col("_k") % 26).alias("_prep"),
                       ((e * 104729) % 17 - 8).alias("_noise"))
    d10, prep, noise, cents = F.col("_d10"), F.col("_prep"), F.col("_noise"), F.col("_cents")
    hour_start, peak = F.col("_hour_start"), F.col("_peak")
    late = ((F.lit(10) * prep + F.lit(3) * d10 + F.lit(10) * noise
             + F.when(peak, F.lit(PEAK_DELAY)).otherwise(F.lit(0))) > LATE_THRESHOLD).cast("int")

    order_id = (F.when(_m(e, 101, 1), F.lit(""))
                .when(_m(e, 29, 7), F.concat(F.lit("EV-"), (e - 1).cast("string")))
                .when(_m(e, 13, 0), F.concat(F.lit(" EV-"), e.cast("string")))
                .otherwise(F.concat(F.lit("EV-"), e.cast("string"))))
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    ts_text = (F.when(_m(e, 53, 9), F.lit("2024-13-01T00:00:00Z"))
               .when(_m(e, 59, 10), F.regexp_replace(iso, "T", " "))
               .otherwise(iso))
    distance = (F.when(_m(e, 31, 2), F.lit("-1.0"))
                .when(_m(e, 37, 3), F.lit("999.0"))
                .when(_m(e, 97, 5), F.lit("nan"))
                .otherwise(F.concat((d10 / 10).cast("long").cast("string"), F.lit("."),
                                    (d10 % 10).cast("string"))))
    prep_text = (F.when(_m(e, 41, 4), F.lit("n/a"))
                 .when(_m(e, 83, 6), F.lit("12.5"))
                 .when(_m(e, 7, 0), F.concat(prep.cast("string"), F.lit(".0")))
                 .otherwise(prep.cast("string")))
    value_text = (F.when(_m(e, 43, 8), F.lit(""))
                  .otherwise(F.concat(F.floor(cents / 100).cast("string"), F.lit("."),
                                      F.lpad((cents % 100).cast("string"), 2, "0"))))
    label_text = F.when(_m(e, 47, 11), F.lit("yes")).otherwise(late.cast("string"))
    n_fields = F.when(_m(e, 61, 12), F.lit(7)).when(_m(e, 67, 13), F.lit(5)).otherwise(F.lit(6))

    return base.select(
        F.concat(F.date_format(hour_start, "yyyyMMdd'T'HHmmss'Z'"), F.lit(FEED_BATCH_SEQ)).alias("batch"),
        hour_start.cast("timestamp").alias("batch_time"),
        e.alias("pos"),
        order_id.alias("f_order_id"), ts_text.alias("f_timestamp"), distance.alias("f_distance_km"),
        prep_text.alias("f_prep_minutes"), value_text.alias("f_order_value"),
        label_text.alias("f_was_late"), n_fields.alias("n_fields"), late.alias("true_late"),
        peak.cast("int").alias("true_peak"))


def order_feed(events: DataFrame) -> DataFrame:
    """Raw batch rows ``(batch, batch_time, pos, raw_line)`` exactly like the text source yields."""
    f = feed_fields(events)
    six = [F.col(c) for c in ("f_order_id", "f_timestamp", "f_distance_km", "f_prep_minutes",
                              "f_order_value", "f_was_late")]
    # concat_ws skips NULLs: a 5-field line drops the label, a 7-field line gets an extra value
    line = F.concat_ws(",", *six[:5],
                       F.when(F.col("n_fields") != 5, six[5]),
                       F.when(F.col("n_fields") == 7, F.lit("x")))
    return f.select("batch", "batch_time", "pos", line.alias("raw_line"))
