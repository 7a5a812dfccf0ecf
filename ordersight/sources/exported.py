"""Readers for exported batch files (features, predictions, rejects), as the metric, scoring and training jobs scan them.

Columns are found by name in each file's own header: a file's header becomes a map from names to positions, which is
joined to its records, and a value is taken from the record's fields by that position.  So files of one folder may
order their columns differently or have more of them.  Records over several lines are read as in raw files.

The all-or-nothing rule holds per batch: a file that cannot be read, that lacks a column or that has one unusable row skips its
batch, with the reason (and the line, counting records, the header being line 1) in the returned status frame: batch,
rows, usable, first_bad_pos, skip_reason.  ``READERS`` maps a folder kind to its reader (UDF-03: add a kind by
adding a function).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import batch_time_of, finite_number, strict_iso_timestamp
from ..operators.guards import usable_training_row
from . import raw_files

#: The batch of a file: from its folder (``batch=<key>``) or its name (``features_<key>.csv``).
_BATCH_DIR, _BATCH_NAME = r"/batch=([^/]+)/[^/]+$", r"/[a-z]+_([^/]+)\.csv$"


def _files(placed: DataFrame, columns: list[str], missing_text: str) -> DataFrame:
    """path, batch, batch_time, skip_reason, multiline, first_pos, places (of ``columns``) of each file."""
    line = F.col("line")
    per = placed.groupBy("path").agg(
        F.min_by("line", "pos").alias("_first"), F.min("pos").alias("first_pos"), F.max("size").alias("_size"),
        F.sum(F.octet_length(line)).alias("_bytes"), F.count(F.lit(1)).alias("_lines"),
        F.bool_and(F.is_valid_utf8(line)).alias("_utf8"), F.bool_or(F.instr("line", "\u0000") > 0).alias("_nul"),
        F.bool_or(raw_files.may_span(line)).alias("multiline"))
    bom, fault = raw_files.text_faults(F.col("_size"), F.col("_bytes"), F.col("_lines"), F.col("_utf8"), F.col("_nul"))
    header = raw_files.csv_fields(F.regexp_replace("_first", "\r$", ""))
    # a BOM is part of the first name there, so that name is not found
    header = F.when(bom, F.transform(header, lambda f, i: F.when(i == 0, F.concat(F.lit(chr(0xFEFF)), f)).otherwise(f))).otherwise(header)
    per = per.withColumns({"_header": header, "_fault": fault})
    places = F.array(*[F.array_position("_header", c).cast("int") for c in columns])
    absent = F.filter(F.array(*[F.lit(c) for c in columns]), lambda c: ~F.array_contains("_header", c))
    batch = F.coalesce(F.nullif(F.regexp_extract("path", _BATCH_DIR, 1), F.lit("")), F.regexp_extract("path", _BATCH_NAME, 1))
    lacks = F.when(F.size(absent) > 0, F.replace(F.lit(missing_text), F.lit("{}"), F.array_join(absent, ", ")))
    return per.select("path", batch.alias("batch"), batch_time_of(batch).alias("batch_time"), F.coalesce("_fault", lacks).alias("skip_reason"),
                      "multiline", "first_pos", places.alias("places"))


def read_columns(spark: SparkSession, path: str, columns: list[str], unusable: Column | None = None, with_line: bool = False,
                 missing_text: str = "missing column {}") -> tuple[DataFrame, DataFrame]:
    """(``columns`` as text, batch, batch_time, pos) of usable batches, and the status frame.

    ``unusable`` is the reason why a row is unusable, null where it is usable; a record that is too short has null
    values.  ``with_line`` adds the line of the first such row to the reason.
    """
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(path).select("value", "_metadata")
    placed = raw_files.placed_lines(lines)
    records, files = raw_files.records_of(placed, _files(placed, columns, missing_text), ["batch", "batch_time", "places"])
    fields = records.where(F.col("raw_line") != "").withColumn("_f", raw_files.csv_fields(F.col("raw_line")))
    rows = fields.select("path", "pos", "batch", "batch_time", *[F.get("_f", F.get("places", F.lit(i)) - 1).alias(c) for i, c in enumerate(columns)])
    judged = rows.withColumn("_why", unusable if unusable is not None else F.lit(None).cast("string"))
    per = judged.groupBy("path").agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.when(F.col("_why").isNotNull(), F.struct("pos", "_why"))).alias("_bad")).checkpoint()
    bad = per.where("_bad IS NOT NULL").select("path", F.col("_bad.pos").alias("_bad_pos"), F.col("_bad._why").alias("_reason"))
    if with_line:
        # records up to the first bad one, in files that have one
        number = rows.select("path", "pos").join(bad, "path").where(F.col("pos") <= F.col("_bad_pos")).groupBy("path").agg((F.count(F.lit(1)) + 1).alias("_line"))
        bad = bad.join(number, "path").withColumn("_reason", F.concat("_reason", F.lit(" on line "), F.col("_line").cast("string")))
    status = files.select("path", "batch", "skip_reason").join(per.select("path", "rows"), "path", "left").join(bad.select("path", "_bad_pos", "_reason"), "path", "left")
    first = F.struct("path", F.coalesce("skip_reason", "_reason").alias("why"), F.col("_bad_pos").alias("pos"))
    guard = status.groupBy("batch").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"), F.min(F.when(F.coalesce("skip_reason", "_reason").isNotNull(), first)).alias("_b"))
    guard = guard.select("batch", "rows", F.col("_b").isNull().alias("usable"), F.col("_b.pos").alias("first_bad_pos"), F.col("_b.why").alias("skip_reason")).checkpoint()
    kept = rows.join(guard.where("NOT usable").select("batch"), "batch", "left_anti")
    return kept.select(*columns, "batch", "batch_time", "pos"), guard


def _reason(usable: Column, text: str) -> Column:
    return F.when(~F.coalesce(usable, F.lit(False)), F.lit(text))


def read_features(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC-09: (order_id, timestamp, batch, batch_time); a bad timestamp drops the batch."""
    time = strict_iso_timestamp(F.col("timestamp"))
    rows, guard = read_columns(spark, path, ["order_id", "timestamp"], _reason(time.isNotNull(), "unreadable timestamp"))
    return rows.select("order_id", time.alias("timestamp"), "batch", "batch_time"), guard


def read_predictions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC-10: a non-numeric probability or a flag outside {0, 1} drops the batch."""
    number = finite_number(F.col("late_probability"))
    ok = number.isNotNull() & F.col("predicted_late").isin("0", "1")
    rows, guard = read_columns(spark, path, ["order_id", "late_probability", "predicted_late", "checkpoint_id"], _reason(ok, "non-numeric prediction"))
    return rows.select("order_id", number.alias("late_probability"), F.col("predicted_late").cast("int").alias("predicted_late"), "checkpoint_id", "batch"), guard


def read_rejects(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC-11: reason only; the batch time comes from the batch key (the row's own time may be the defect)."""
    rows, guard = read_columns(spark, path, ["reason"])
    return rows.select("reason", "batch", "batch_time"), guard


def read_for_scoring(spark: SparkSession, path: str, feature_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """SRC-08/ML-12: ``order_id`` + the columns the model lists; one non-numeric value skips the batch, naming column and line."""
    number = {c: finite_number(F.trim(F.col(c))) for c in feature_cols}
    why = F.coalesce(*[_reason(number[c].isNotNull(), f"non-numeric {c}") for c in feature_cols])
    rows, guard = read_columns(spark, path, ["order_id", *feature_cols], why, with_line=True)
    return rows.select("order_id", *[number[c].alias(c) for c in feature_cols], "batch", "batch_time", "pos"), guard


def read_for_training(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC-07, FLT-11: labelled rows of usable batches; a batch with one unusable value is left out whole, naming the line."""
    ok = usable_training_row(F.col("distance_km"), F.col("prep_minutes"), F.col("was_late"))
    rows, guard = read_columns(spark, path, ["distance_km", "prep_minutes", "was_late", "timestamp"], _reason(ok, "unusable value"),
                               with_line=True, missing_text="missing columns")
    number = lambda c: finite_number(F.regexp_replace(c, r"^\s+|\s+$", ""))
    return rows.select(number("distance_km").alias("distance_km"), number("prep_minutes").alias("prep_minutes"),
                       F.col("was_late").cast("int").alias("was_late"), strict_iso_timestamp(F.col("timestamp")).alias("timestamp"),
                       "batch", "batch_time", "pos"), guard


READERS: dict[str, Callable[[SparkSession, str], tuple[DataFrame, DataFrame]]] = {
    "features": read_features,
    "predictions": read_predictions,
    "rejects": read_rejects,
    "training": read_for_training,
}
