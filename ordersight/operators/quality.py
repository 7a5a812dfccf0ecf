"""Row-quality rules: one declarative rule list compiled into a single CASE cascade.

The pipeline per raw row is
  parse (``from_csv``) -> trim -> first-occurrence claim per (batch, id) -> rule cascade
and everything after parsing is one projection, so Catalyst keeps it inside
whole-stage codegen.  Duplicate detection is the only step that needs data from
other rows; it is a partial+final ``min(pos)`` aggregate per (batch, id) joined
back (AQE splits a hot key on the large side), never a per-group buffer.
"""
from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import finite_number, iso_hour, or_empty, strict_iso_timestamp, strip, whole
from ..options import RAW_COLUMNS, REJECT_REASONS, QualityOptions

CORRUPT = "_corrupt"
RAW_SCHEMA_DDL = ", ".join(f"{c} STRING" for c in RAW_COLUMNS) + f", {CORRUPT} STRING"


@dataclass(frozen=True)
class QualityRule:
    """A reject reason and the predicate that fires it (evaluated on trimmed columns ``t_*``)."""
    code: str
    predicate: Callable[[QualityOptions], Column]


def _t(name: str) -> Column:
    return F.col(f"t_{name}")


def _in_range(value: Column, bounds: tuple) -> Column:
    low, high = bounds
    return (value > F.lit(low)) & (value <= F.lit(high))


def default_rules() -> list[QualityRule]:
    """The reference cascade, in order; extend or replace to add checks."""
    def dup(_o):
        return F.col("_dup")

    def wrong_count(_o):
        return F.col("_wrong_count")

    def blank(_o):
        return F.exists(F.array(*[_t(c) for c in RAW_COLUMNS]), lambda x: x == "")

    def bad_ts(_o):
        return F.col("_ts").isNull()

    def nan(_o):
        return F.col("_d").isNull() | F.col("_p").isNull() | F.col("_v").isNull()

    def out_of_range(o):
        return ~(_in_range(F.col("_d"), o.ranges["distance_km"])
                 & _in_range(F.col("_p"), o.ranges["prep_minutes"])
                 & _in_range(F.col("_v"), o.ranges["order_value"]))

    def bad_label(_o):
        return ~_t("was_late").isin("0", "1")

    preds = dict(duplicate_id=dup, wrong_field_count=wrong_count, blank=blank,
                 bad_timestamp=bad_ts, not_a_number=nan, out_of_range=out_of_range,
                 bad_label=bad_label)
    return [QualityRule(code, preds[code]) for code in REJECT_REASONS]


def cascade(rules: list[QualityRule], options: QualityOptions) -> Column:
    """First failing rule wins; NULL means the row is kept."""
    expr = None
    for rule in rules:
        cond = F.coalesce(rule.predicate(options), F.lit(True))
        expr = F.when(cond, F.lit(rule.code)) if expr is None else expr.when(cond, F.lit(rule.code))
    return expr


def parse_raw(raw: DataFrame, skip_blank: bool = True) -> DataFrame:
    """``raw_line`` -> the six raw fields (untrimmed) + field-count flag.  Blank lines are skipped.

    Short and long records both set the corrupt column, the first six values stay
    readable; a quoted comma is one field.  ``skip_blank=False`` is for generated
    feeds that never contain blank lines (the filter would otherwise be pushed
    into the generator and compute every line twice).
    """
    src = raw.filter(F.col("raw_line") != "") if skip_blank else raw
    parsed = src.withColumn(
        "_rec", F.from_csv("raw_line", RAW_SCHEMA_DDL,
                           {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"'}))
    cols = [c for c in raw.columns if c != "_rec"]
    return parsed.select(*cols, *[F.col(f"_rec.{c}").alias(c) for c in RAW_COLUMNS],
                         F.col(f"_rec.{CORRUPT}").isNotNull().alias("_wrong_count"))


def first_csv_field(line: Column) -> Column:
    """The first CSV field of a line, equal to ``from_csv``'s first value."""
    return F.when(line.startswith('"'),
                  F.from_csv(line, RAW_SCHEMA_DDL, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"'})
                  .getField("order_id")).otherwise(F.substring_index(line, ",", 1))


def with_trimmed(parsed: DataFrame) -> DataFrame:
    """Trimmed copies ``t_*`` plus each value parsed once (``_ts``, ``_d``, ``_p``, ``_v``).

    Parsing once keeps the cascade small (the rules only compare parsed columns),
    so the generated code stays compact; Catalyst does not re-inline non-cheap
    expressions into the later projection.
    """
    trimmed = parsed.select("*", *[strip(F.col(c)).alias(f"t_{c}") for c in RAW_COLUMNS])
    # a number that two tests read is a column of its own, so its text is parsed once
    numbers = trimmed.select(
        "*", strict_iso_timestamp(_t("timestamp")).alias("_ts"),
        finite_number(_t("distance_km")).alias("_d"),
        finite_number(_t("prep_minutes")).alias("_prep"),
        finite_number(_t("order_value")).alias("_v"))
    return numbers.select(*trimmed.columns, "_ts", "_d", whole(F.col("_prep")).alias("_p"), "_v")


def first_occurrence(trimmed: DataFrame) -> DataFrame:
    """Adds ``_dup``: a non-blank trimmed id seen earlier in the same batch (WIN-01).

    The first occurrence claims the id even when it is rejected for another reason.
    Blank ids claim nothing: each gets a key of its own (NUL + position, which no
    trimmed id can equal), so blanks are neither duplicates nor one hot key.  The
    key is non-nullable on purpose: a nullable join key makes Catalyst infer an
    ``isnotnull`` filter that it pushes into the scan, parsing every line twice.
    """
    t = F.col("t_order_id")

    def claim_key(tid: Column) -> Column:
        return F.coalesce(F.when(tid != "", tid).otherwise(F.concat(F.lit("\u0000"), F.col("pos").cast("string"))),
                          F.lit("\u0000"))

    # the claims side needs only the first field: for an unquoted first field that is the
    # text before the first comma (CSV quoting starts only at a field's first character),
    # so only lines starting with a quote pay for a full parse on this side
    first = strip(first_csv_field(F.col("raw_line"))) if "raw_line" in trimmed.columns else t
    claims = (trimmed.groupBy("batch", claim_key(first).alias("_claim_id"))
              .agg(F.min("pos").alias("_first_pos")))
    joined = trimmed.withColumn("_claim_id", claim_key(t)).join(claims, ["batch", "_claim_id"], "left")
    return joined.withColumn("_dup", F.coalesce((t != "") & (F.col("pos") > F.col("_first_pos")), F.lit(False))) \
                 .drop("_claim_id", "_first_pos")


def annotate(raw: DataFrame, options: QualityOptions | None = None,
             rules: list[QualityRule] | None = None, skip_blank: bool = True) -> DataFrame:
    """Every raw row with its ``reason`` (NULL = kept). Keeps raw, trimmed and lineage columns."""
    options = options or QualityOptions()
    rules = rules or default_rules()
    rows = first_occurrence(with_trimmed(parse_raw(raw, skip_blank)))
    return rows.withColumn("reason", cascade(rules, options))


def features(annotated: DataFrame, options: QualityOptions | None = None, carry: tuple = ()) -> DataFrame:
    """Kept rows in canonical typed form (PRJ-02..04); ``carry`` names further columns to keep."""
    options = options or QualityOptions()
    hour = iso_hour(_t("timestamp"))
    return annotated.where(F.col("reason").isNull()).select(
        _t("order_id").alias("order_id"),
        F.col("_ts").alias("timestamp"),
        hour.alias("hour"),
        hour.isin(*options.peak_hours).cast("int").alias("is_peak"),
        F.round(F.col("_d"), 1).alias("distance_km"),
        F.col("_p").cast("int").alias("prep_minutes"),
        F.round(F.col("_v"), 2).alias("order_value"),
        _t("was_late").cast("int").alias("was_late"),
        "batch", "batch_time", "pos", *carry)


def rejects(annotated: DataFrame) -> DataFrame:
    """Rejected rows: original untrimmed fields (NULL -> ''), reason and the verbatim line."""
    return annotated.where(F.col("reason").isNotNull()).select(
        *[or_empty(F.col(c)).alias(c) for c in RAW_COLUMNS], "reason", "raw_line",
        "batch", "batch_time", "pos")


def batch_stats(annotated: DataFrame) -> DataFrame:
    """Per batch: rows, kept, rejected and one count column per reason (AGG-01), plus STR-10 text."""
    per_reason = [F.count_if(F.col("reason") == r).cast("long").alias(r) for r in REJECT_REASONS]
    stats = annotated.groupBy("batch").agg(
        F.count(F.lit(1)).cast("long").alias("rows_in"),
        F.count_if(F.col("reason").isNull()).cast("long").alias("kept"),
        F.count_if(F.col("reason").isNotNull()).cast("long").alias("rejected"),
        *per_reason)
    parts = F.array(*[F.when(F.col(r) > 0, F.concat(F.lit(r + " "), F.col(r).cast("string")))
                      for r in REJECT_REASONS])
    return stats.withColumn("reasons_text", F.array_join(parts, ", "))


def running_totals(stats: DataFrame) -> DataFrame:
    """Cumulative kept/rejected and file count in batch order (WIN-11).

    Batch keys start with their day (``yyyyMMdd``), so the running sums are two-level
    (``ordering.running_sum``): parallel per day, offsets from one row per day.
    """
    from .ordering import running_sum
    s = stats.select("batch", "kept", "rejected", F.lit(1).cast("long").alias("files"))
    r = running_sum(s, "batch", ["kept", "rejected", "files"], F.substring("batch", 1, 8))
    return r.select("batch", "kept", "rejected", F.col("kept_cum").alias("total_kept"),
                    F.col("rejected_cum").alias("total_rejected"), F.col("files_cum").alias("files"))


def run_totals(stats: DataFrame) -> DataFrame:
    """Files, kept and rejected over all processed batches (AGG-02)."""
    return stats.agg(F.count(F.lit(1)).cast("long").alias("files"),
                     F.sum("kept").cast("long").alias("kept"),
                     F.sum("rejected").cast("long").alias("rejected"))


# Every defect a generated messy row can carry, as (name, column, exact value),
# checked in this order after duplicates.
MESSY_DEFECTS = (
    ("blank", "order_value", ""),
    ("negative_distance", "distance_km", "-1.0"),
    ("missing_prep", "prep_minutes", "n/a"),
    ("text_label", "was_late", "yes"),
    ("outlier_distance", "distance_km", "999.0"),
)


def defect_audit(raw_fields: DataFrame, prefix: str = "f_") -> DataFrame:
    """FLT-15: name the injected defect of each raw row; duplicates (exact id seen earlier
    in the batch, blank ids included) come first, then the exact defect values.

    ``raw_fields`` holds the six raw text columns (named ``prefix + column``), ``batch`` and ``pos``.
    """
    oid = F.col(prefix + "order_id")
    claims = raw_fields.groupBy("batch", oid.alias("_id")).agg(F.min("pos").alias("_first"))
    j = raw_fields.withColumn("_id", oid).join(claims, ["batch", "_id"], "left")
    defect = F.when(F.col("pos") > F.col("_first"), F.lit("duplicate_id"))
    for name, column, value in MESSY_DEFECTS:
        defect = defect.when(F.col(prefix + column) == value, F.lit(name))
    return j.select("batch", "pos", defect.alias("defect"))


def messy_per_batch(audit: DataFrame) -> DataFrame:
    """AGG-26: rows per batch and how many of them carry a defect."""
    return audit.groupBy("batch").agg(F.count(F.lit(1)).cast("long").alias("rows"),
                                      F.count_if(F.col("defect").isNotNull()).cast("long").alias("messy"))


def features_for_export(feats: DataFrame) -> DataFrame:
    """Canonical text rendering of a features frame (CSV export), input order kept via ``pos``."""
    return feats.select(
        "order_id", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.col("hour").cast("string").alias("hour"), F.col("is_peak").cast("string").alias("is_peak"),
        F.format_string("%.1f", "distance_km").alias("distance_km"),
        F.col("prep_minutes").cast("string").alias("prep_minutes"),
        F.format_string("%.2f", "order_value").alias("order_value"),
        F.col("was_late").cast("string").alias("was_late"), "batch", "pos")


__all__ = ["QualityRule", "default_rules", "cascade", "parse_raw", "with_trimmed", "first_occurrence",
           "annotate", "features", "rejects", "batch_stats", "running_totals", "run_totals",
           "defect_audit", "messy_per_batch", "features_for_export"]
