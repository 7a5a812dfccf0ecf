"""Multi-party perspective rotation: a dialogue rendered once for each participant.

In a participant's view its own turns are ``assistant`` turns and carry the loss mask; every other
speaker is a named user; system turns stay system turns.  A view is returned as one row per message with
its place in the rendered dialogue, so a dialogue of any length is never put together in one task.

Defined cases: a null or blank speaker is ``unknown``; a null text is empty; system speakers have no view
of their own (a dialogue of system turns alone has none); equal turn numbers are ordered by speaker, then
by md5 of the text; repeated rows are repeated messages; null conversation ids are one conversation, null
turns come first.  ``<|`` inside texts and names is written ``<||``, so no text can close its own message.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

SYSTEM = ("system",)


def _escaped(c: Column) -> Column:
    return F.replace(c, F.lit("<|"), F.lit("<||"))


def _dealt(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows in global order of ``keys``, range-partitioned, with ``at`` rising along that order."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = "_input"  # splits runs of equal rows over partitions
    ordered = df.withColumn(last, F.monotonically_increasing_id()).repartitionByRange(n, *keys, last)
    return stage(ordered.sortWithinPartitions(*keys, last).drop(last).withColumn("at", F.monotonically_increasing_id()), name)


def perspectives(df: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role",
                 text: str = "text", system: tuple[str, ...] = SYSTEM) -> DataFrame:
    """conv, participant, position, turn, speaker, role_out, rendered, start, length, mask_start, mask_length.

    ``start`` counts characters of the view; ``mask_start`` and ``mask_length`` give the characters that
    are trained on (the participant's text and the end mark), with length 0 for other messages.
    """
    name = F.trim(F.coalesce(F.col(speaker), F.lit("")))
    said = df.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"),
        F.when(name == "", F.lit("unknown")).otherwise(name).alias("who"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    said = said.withColumn("key", F.md5(F.encode("body", "UTF-8")))
    rows = _dealt(said, ["conv", "turn", "who", "key"], "dialogue").drop("key").withColumn("block", F.shiftright("at", 33))

    people = rows.filter(~F.col("who").isin(*system)).select(F.col("conv").alias("p_conv"), F.col("who").alias("participant")).distinct()
    seen = rows.join(people, rows.conv.eqNullSafe(people.p_conv)).drop("p_conv")
    own = F.col("who") == F.col("participant")
    role_out = F.when(F.col("who").isin(*system), F.lit("system")).when(own, F.lit("assistant")).otherwise(F.lit("user"))
    label = F.regexp_replace(_escaped(F.col("who")), r"\s+", " ")
    header = F.concat(F.lit("<|im_start|>"), F.col("role_out"),
                      F.when(F.col("role_out") == "user", F.concat(F.lit(" name="), label)).otherwise(F.lit("")), F.lit("\n"))
    seen = seen.withColumn("role_out", role_out).withColumn("header", header)
    seen = seen.withColumn("rendered", F.concat("header", _escaped(F.col("body")), F.lit("<|im_end|>\n")))
    seen = seen.select("conv", "participant", "block", "at", "turn", "who", "role_out", "rendered",
                       F.length("rendered").cast("long").alias("length"), F.length("header").cast("long").alias("head"))

    # Two-level running sums: inside (view, block), plus the totals of the view's earlier blocks.
    view = ["conv", "participant"]
    sums = seen.groupBy(*view, "block").agg(F.count("*").alias("n"), F.sum("length").alias("chars"))
    earlier = Window.partitionBy(*view).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(F.col("conv").alias("b_conv"), F.col("participant").alias("b_part"), F.col("block").alias("b_block"),
                       F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"),
                       F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("c0"))
    within = Window.partitionBy(*view, "block").orderBy("at")
    placed = seen.withColumn("rank", F.row_number().over(within)).withColumn(
        "here", F.sum("length").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length"))
    full = placed.join(base, F.col("conv").eqNullSafe(F.col("b_conv")) & (F.col("participant") == F.col("b_part"))
                       & (F.col("block") == F.col("b_block")))
    start = F.col("c0") + F.col("here")
    mine = F.col("role_out") == "assistant"
    return full.select(
        F.col("conv").alias(conv), "participant", (F.col("n0") + F.col("rank")).cast("long").alias("position"),
        F.col("turn").alias(turn), F.col("who").alias("speaker"), "role_out", "rendered", start.cast("long").alias("start"), "length",
        F.when(mine, start + F.col("head")).otherwise(start).cast("long").alias("mask_start"),
        # the line end after the end mark is not trained on
        F.when(mine, F.col("length") - F.col("head") - 1).otherwise(F.lit(0)).cast("long").alias("mask_length"))
