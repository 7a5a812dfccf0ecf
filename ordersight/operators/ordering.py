"""Exact global order statistics without a single-partition window over rows.

``order_cutoff`` finds the key of the k-th row of a total order with three small
aggregates (per major key, per coarse minor bucket, one bounded bucket), so a
time-ordered split becomes a filter with two scalar thresholds: no sort or
shuffle of the rows themselves.

``global_position`` numbers every row:

A total order over a table is range-partitioned (sampling picks balanced
bounds, so a hot key still spreads over partitions when the order key is
unique), sorted within partitions, and each row gets its index inside its
partition from ``monotonically_increasing_id`` (documented layout: partition id
in the upper 31 bits, record number in the lower 33).  Per-partition counts — one
row per partition — give the offsets, which are broadcast back.  This is the
DataFrame form of ``zipWithIndex``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_LOW_BITS = (1 << 33) - 1


def global_position(df: DataFrame, order_cols: list[str], num_partitions: int | None = None,
                    name: str = "position") -> DataFrame:
    """Adds ``name``: 0-based rank of each row in the order of ``order_cols`` (which must be unique)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    mid = F.monotonically_increasing_id()
    tagged = ranged.withColumn("_mid", mid).select(
        "*", F.shiftright("_mid", 33).alias("_part"), F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)).alias("_idx"))
    tagged = tagged.persist()   # one partitioning for both consumers (see module doc)
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # one row per partition: a proven, tiny broadcast
    return tagged.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_off") + F.col("_idx")).cast("long").alias(name))


def order_cutoff(df: DataFrame, k: Column, major: str = "batch", minor: str = "pos",
                 shift: int = 20, major_prefix: int = 8) -> tuple[Column, Column]:
    """Scalar columns ``(major, minor)`` of the k-th row (1-based) in ``(major, minor)`` order.

    (``minor`` must be unique within a major key.)  Steps, each an aggregate:
    rows per major key -> running total over those (one row per key) -> the cutoff
    key and the rank left inside it; inside that key, rows per ``minor >> shift``
    bucket -> the bucket holding the rank; inside that bucket (at most 2**shift
    rows, since minors are unique) the exact row by ``row_number``.  A hot major
    key never lands in one task as a whole.  NULLs when ``k`` < 1 or beyond the end.
    """
    per = df.groupBy(major).agg(F.count(F.lit(1)).alias("_c"))
    # one row per major key; the running total is itself two-level (by key prefix)
    cum = running_sum(per, major, ["_c"], F.substring(F.col(major).cast("string"), 1, major_prefix)) \
        .withColumnRenamed("_c_cum", "_cum")
    hit = cum.where((F.col("_cum") >= k) & (k >= 1)).agg(
        F.min_by(F.struct(F.col(major).alias("m"), (k - (F.col("_cum") - F.col("_c"))).alias("r")),
                 F.col(major)).alias("h"))
    h = hit.select("h").scalar()              # one subquery for both fields
    cut_major, rank_in = h.getField("m"), h.getField("r")
    inside = df.where(F.col(major) == cut_major).select(F.col(minor))
    coarse = inside.groupBy(F.shiftright(F.col(minor), shift).alias("_b")).agg(F.count(F.lit(1)).alias("_c"))
    upto_b = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cb = coarse.select("_b", "_c", F.sum("_c").over(upto_b).alias("_cum"))
    hit_b = cb.where(F.col("_cum") >= rank_in).agg(
        F.min_by(F.struct(F.col("_b").alias("b"), (rank_in - (F.col("_cum") - F.col("_c"))).alias("r")),
                 F.col("_b")).alias("h"))
    hb = hit_b.select("h").scalar()
    bucket, rank_b = hb.getField("b"), hb.getField("r")
    fine = inside.where(F.shiftright(F.col(minor), shift) == bucket) \
        .select(minor, F.row_number().over(Window.orderBy(minor)).alias("_rn"))
    cut_minor = fine.where(F.col("_rn") == rank_b).select(minor).scalar()
    return cut_major, cut_minor


def at_or_before(major_col: Column, minor_col: Column, cut_major: Column, cut_minor: Column) -> Column:
    """True for rows whose ``(major, minor)`` key is <= the cutoff key (False when there is no cutoff)."""
    return F.coalesce((major_col < cut_major) | ((major_col == cut_major) & (minor_col <= cut_minor)),
                      F.lit(False))


def running_sum(df: DataFrame, order_col: str, value_cols: list[str], coarse: Column,
                inclusive: bool = True, suffix: str = "_cum") -> DataFrame:
    """Running sums of ``value_cols`` in ``order_col`` order, without a single-partition window.

    Two levels: a window partitioned by ``coarse`` (e.g. the day of a batch) sums
    inside each coarse group in parallel, and the coarse groups' totals -- one row
    per group -- give the offsets through a tiny ordered window, broadcast back.
    ``order_col`` must be ordered consistently with ``coarse``.
    """
    d = df.withColumn("_coarse", coarse)
    frame = (Window.partitionBy("_coarse").orderBy(order_col)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1))
    inner = d.select("*", *[F.coalesce(F.sum(c).over(frame), F.lit(0)).alias(f"_in_{c}") for c in value_cols])
    totals = d.groupBy("_coarse").agg(*[F.sum(c).alias(f"_t_{c}") for c in value_cols])
    before = Window.orderBy("_coarse").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_coarse", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}")
                                         for c in value_cols])
    out = inner.join(F.broadcast(offsets), "_coarse")
    return out.select(*df.columns, *[(F.col(f"_o_{c}") + F.col(f"_in_{c}")).alias(c + suffix) for c in value_cols])
