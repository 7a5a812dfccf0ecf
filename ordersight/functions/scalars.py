"""Scalar column helpers built only from ``pyspark.sql.functions``.

Everything here stays inside whole-stage codegen: no Python row functions.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..options import ISO_PATTERN, STAMP_PATTERN

__all__ = [
    "strip", "or_empty", "is_blank", "number_text_ok", "finite_number", "whole_number", "whole",
    "strict_iso_timestamp", "iso_hour", "batch_key_of", "batch_time_of", "epoch_floor",
    "format_iso", "format_stamp", "checkpoint_name", "checkpoint_version", "pct_text",
    "pp_text", "about_text", "duration_text", "signed_thousands", "thousands",
]

# A plain decimal literal: no nan/inf, no Java 'd'/'f' suffixes, no underscores.
_NUMBER_RE = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
_ISO_SHAPE_RE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
_WS_RE = r"^\s+|\s+$"
# every character a text must start or end with for _WS_RE to match: white space, and line ends ($ stops before one)
_EDGES = " \t\n\x0b\f\r\u0085\u2028\u2029"


def strip(col: Column) -> Column:
    """Trim leading/trailing whitespace of any kind (``btrim`` only strips spaces); NULL -> ''."""
    text = F.coalesce(col, F.lit(""))
    # most texts have nothing to strip: a look at their ends is far cheaper than the expression
    return F.when(F.btrim(text, F.lit(_EDGES)) == text, text).otherwise(F.regexp_replace(text, _WS_RE, ""))


def or_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def is_blank(col: Column) -> Column:
    return or_empty(col) == ""


def number_text_ok(text: Column) -> Column:
    return text.rlike(_NUMBER_RE)


def finite_number(text: Column) -> Column:
    """Parsed double of a plain decimal literal, NULL if not a finite number."""
    parsed = text.try_cast("double")
    ok = number_text_ok(text) & parsed.isNotNull() & (F.abs(parsed) < F.lit(float("inf")))
    return F.when(ok, parsed)


def whole_number(text: Column) -> Column:
    """Integer value of a finite number with no fractional part ('18.0' -> 18), else NULL."""
    return whole(finite_number(text))


def whole(value: Column) -> Column:
    """The number as an integer, NULL where it has a fractional part."""
    return F.when(value == F.floor(value), value.cast("long"))


def strict_iso_timestamp(text: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` with a real calendar instant, else NULL (month 13, Feb 30, 24:00)."""
    return F.when(text.rlike(_ISO_SHAPE_RE), F.try_to_timestamp(text, F.lit(ISO_PATTERN)))


def iso_hour(text: Column) -> Column:
    """UTC hour of a validated ISO text, read from the text (independent of session clock)."""
    return F.substring(text, 12, 2).cast("int")


def batch_key_of(file_name: Column, prefix: str = "orders_", suffix: str = ".csv") -> Column:
    """``orders_20240101T000000Z_0001.csv`` -> ``20240101T000000Z_0001``; '' when the name does not fit."""
    pattern = "^" + prefix.replace(".", r"\.") + r"(\d{8}T\d{6}Z_\d{4,})" + suffix.replace(".", r"\.") + "$"
    return F.regexp_extract(file_name, pattern, 1)


def batch_time_of(key: Column) -> Column:
    """Batch stamp -> TIMESTAMP; NULL for an impossible stamp (quarantined, never raised)."""
    return F.try_to_timestamp(F.substring_index(key, "_", 1), F.lit(STAMP_PATTERN))


def epoch_floor(ts: Column, seconds: int) -> Column:
    """Floor a timestamp to an epoch-aligned bucket of ``seconds``."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / F.lit(seconds)) * F.lit(seconds))


def format_iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def format_stamp(ts: Column) -> Column:
    return F.date_format(ts, STAMP_PATTERN)


def checkpoint_name(version: Column) -> Column:
    return F.format_string("model_v%04d", version)


def checkpoint_version(checkpoint_id: Column) -> Column:
    """Numeric version of ``model_v<N>``; -1 for anything else."""
    digits = F.regexp_extract(checkpoint_id, r"^model_v(\d+)$", 1)
    return F.coalesce(F.when(digits != "", digits.try_cast("long")), F.lit(-1).cast("long"))


def pct_text(value: Column, digits: int = 1) -> Column:
    return F.when(value.isNull(), F.lit("—")).otherwise(
        F.format_string(f"%.{digits}f%%", F.bround(value, digits)))


def pp_text(now: Column, before: Column, digits: int = 1) -> Column:
    """Signed percentage-point change, -0.0 shown as 0.0; NULL if either side is NULL."""
    change = F.bround(now - before, digits) + F.lit(0.0)
    return F.when(now.isNotNull() & before.isNotNull(),
                  F.format_string(f"%+.{digits}f pp", change))


def thousands(value: Column) -> Column:
    return F.format_string("%,d", value.cast("long"))


def signed_thousands(value: Column) -> Column:
    return F.format_string("%+,d", value.cast("long"))


def about_text(value: Column) -> Column:
    """~value: nearest 10 (half-even) from 100 up, else nearest whole number."""
    return F.when(value >= 100, thousands(F.bround(value, -1))).otherwise(
        F.bround(value, 0).cast("long").cast("string"))


def duration_text(minutes: Column) -> Column:
    m = minutes.cast("long")
    return (F.when(m < 120, F.concat(m.cast("string"), F.lit(" minutes")))
            .when(m < 48 * 60, F.concat((m / 60).cast("long").cast("string"), F.lit(" hours")))
            .otherwise(F.concat((m / 1440).cast("long").cast("string"), F.lit(" days"))))
