"""Downstream jobs over *committed* epochs: scoring and volume follow the cleaning job's ledger, not its data folder.

A cleaning epoch exists once its ledger row is written.  A downstream query streams the ledger, but only as a signal:
what it works on is the difference between the committed epochs and the epochs in its own ledger.  So

- an epoch that failed between its data and its ledger row is never seen;
- an epoch that is replayed, which rewrites its data and ledger files, is already in the downstream ledger and is left alone;
- a downstream epoch that failed before its own ledger row is worked on again and replaces what it wrote, since its
  output lies under the *upstream* epoch's partition;
- epochs that could not be scored yet (no model) stay pending until a model exists, without a copy of their rows.

Readers join outputs with the downstream ledger, so half-written epochs are invisible.  Epoch numbers are control data:
one per micro-batch, worked on in passes of ``EPOCHS`` so a long backlog never becomes one job.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import quality, scoring
from ..operators.metrics import bucket_of, epoch
from ..options import WindowOptions
from .jobs import ANNOTATED, LEDGER, _start, _stored, _write_epoch

EPOCHS = 64
PREDICTIONS = ("order_id string, late_probability double, predicted_late int, checkpoint_id string, batch string, "
               "batch_time timestamp, pos long, epoch long")
SCORE_LEDGER = "batch string, status string, skip_reason string, checkpoint_id string, scored long, flagged long, epoch long"
COUNTS = "bucket long, orders long, epoch long"
VOLUME_LEDGER = "rows long, epoch long"


def table_at(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A partitioned table, empty where its folder does not exist yet."""
    if not _stored(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def ledger_stream(spark: SparkSession, out_root: str) -> DataFrame:
    """New ledger files of the cleaning job: the signal that something may be pending."""
    return spark.readStream.schema(LEDGER).parquet(f"{out_root}/ledger")


def pending_epochs(spark: SparkSession, out_root: str, done: str, schema: str) -> list[int]:
    """Committed epochs that the ledger ``done`` does not have, oldest first."""
    have = table_at(spark, f"{out_root}/ledger", LEDGER).select("epoch").distinct()
    seen = table_at(spark, f"{out_root}/{done}", schema).select("epoch").distinct()
    return [r["epoch"] for r in have.join(seen, "epoch", "left_anti").orderBy("epoch").collect()]


def committed_rows(spark: SparkSession, out_root: str, epochs: list[int]) -> DataFrame:
    """Kept rows (typed features, with ``epoch``) of the given committed epochs; other epochs' files are not read."""
    rows = table_at(spark, f"{out_root}/annotated", ANNOTATED).where(F.col("epoch").isin(epochs))
    led = table_at(spark, f"{out_root}/ledger", LEDGER).where(F.col("epoch").isin(epochs) & (F.col("status") == "committed"))
    # a replay that is being written may hold rows of a batch twice for a moment; the ledger names the batches
    return quality.features(rows.join(led.select("epoch", "batch").distinct(), ["epoch", "batch"], "left_semi"), carry=("epoch",))


def _write_epochs(df: DataFrame, path: str) -> None:
    """Replace the partitions of the epochs that ``df`` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(path)


def score_pending(spark: SparkSession, out_root: str, choose_model: Callable[[], tuple | None]) -> int:
    """ST-03, ML-09/11: score every committed epoch that is not scored yet; the number of epochs done.

    One model per pass, chosen at its start.  A batch that already has committed predictions is never scored again, also
    when it was delivered in another epoch.  A batch whose features lack a value, or for which the model gives a
    non-finite probability, gets a ``skipped`` ledger row with the reason and no predictions.
    """
    epochs, done = pending_epochs(spark, out_root, "score_ledger", SCORE_LEDGER), 0
    while epochs and (chosen := choose_model()) is not None:
        now, epochs = epochs[:EPOCHS], epochs[EPOCHS:]
        coefficients, intercept, checkpoint = chosen
        scored = table_at(spark, f"{out_root}/score_ledger", SCORE_LEDGER).where(F.col("status") == "committed")
        rows = committed_rows(spark, out_root, now).join(scored.select("batch").distinct(), "batch", "left_anti")
        p = scoring.logistic(coefficients, intercept)
        bad_value = F.lit(False)
        for name in coefficients:
            bad_value = bad_value | F.coalesce(F.isnan(F.col(name).cast("double")), F.lit(True))
        judged = rows.groupBy("epoch", "batch").agg(
            F.count(F.lit(1)).alias("n"), F.max(bad_value).alias("bad_value"),
            F.max(F.coalesce(F.isnan(p) | (F.abs(p) == F.lit(float("inf"))), F.lit(True))).alias("bad_p"))
        reason = F.when(F.col("bad_value"), F.lit("non-numeric feature")).when(
            F.col("bad_p"), F.lit(f"{checkpoint} produced non-finite probabilities"))
        judged = judged.select("epoch", "batch", reason.alias("skip_reason"))
        usable = rows.join(judged.where(F.col("skip_reason").isNotNull()), ["epoch", "batch"], "left_anti")
        preds = scoring.score_fixed(usable, coefficients, intercept, checkpoint, keep=("batch", "batch_time", "pos", "epoch"))
        _write_epochs(preds, f"{out_root}/predictions")
        # counted from what was written; every pending epoch gets a row, also those without any order
        written = table_at(spark, f"{out_root}/predictions", PREDICTIONS).where(F.col("epoch").isin(now))
        counts = written.groupBy("epoch", "batch").agg(F.count(F.lit(1)).alias("scored"), F.sum("predicted_late").cast("long").alias("flagged"))
        led = judged.join(counts, ["epoch", "batch"], "left")
        every = spark.createDataFrame([(e,) for e in now], "epoch long").join(led, "epoch", "left")
        status = F.when(F.col("batch").isNull(), F.lit("empty")).when(F.col("skip_reason").isNotNull(), F.lit("skipped")).otherwise(F.lit("committed"))
        _write_epochs(every.select(
            "batch", status.alias("status"), "skip_reason", F.lit(checkpoint).alias("checkpoint_id"),
            F.coalesce("scored", F.lit(0)).cast("long").alias("scored"), F.coalesce("flagged", F.lit(0)).cast("long").alias("flagged"), "epoch"),
            f"{out_root}/score_ledger")
        done += len(now)
    return done


def predictions(spark: SparkSession, out_root: str) -> DataFrame:
    """Committed predictions: rows of the epochs and batches in the score ledger."""
    led = table_at(spark, f"{out_root}/score_ledger", SCORE_LEDGER).where(F.col("status") == "committed")
    return table_at(spark, f"{out_root}/predictions", PREDICTIONS).join(led.select("epoch", "batch"), ["epoch", "batch"], "left_semi")


def score_stream(spark: SparkSession, out_root: str, choose_model: Callable[[], tuple | None], checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    """ST-03: scoring as a query over the cleaning job's ledger."""
    return _start(ledger_stream(spark, out_root), lambda _df, _id: score_pending(spark, out_root, choose_model) and None, checkpoint, trigger)


def count_pending(spark: SparkSession, out_root: str, opts: WindowOptions, ts: str = "timestamp") -> int:
    """ST-04/09/11: orders per bucket of every committed epoch that is not counted yet; the number of epochs done.

    Counts are kept per (epoch, bucket) and added when read, so late orders add to their bucket and nothing is dropped.
    """
    epochs, done = pending_epochs(spark, out_root, "volume_ledger", VOLUME_LEDGER), 0
    while epochs:
        now, epochs = epochs[:EPOCHS], epochs[EPOCHS:]
        part = committed_rows(spark, out_root, now).groupBy("epoch", bucket_of(epoch(ts), opts.bucket_seconds).alias("bucket")).agg(
            F.count(F.lit(1)).cast("long").alias("orders"))
        _write_epochs(part.select("bucket", "orders", "epoch"), f"{out_root}/bucket_counts")
        written = table_at(spark, f"{out_root}/bucket_counts", COUNTS).groupBy("epoch").agg(F.sum("orders").cast("long").alias("rows"))
        every = spark.createDataFrame([(e,) for e in now], "epoch long").join(written, "epoch", "left")
        _write_epochs(every.select(F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), "epoch"), f"{out_root}/volume_ledger")
        done += len(now)
    return done


def bucket_counts(spark: SparkSession, out_root: str) -> DataFrame:
    """Orders per bucket over the counted epochs: one row per bucket."""
    led = table_at(spark, f"{out_root}/volume_ledger", VOLUME_LEDGER).where(F.col("rows") > 0).select("epoch").distinct()
    counts = table_at(spark, f"{out_root}/bucket_counts", COUNTS)
    return counts.join(led, "epoch", "left_semi").groupBy("bucket").agg(F.sum("orders").cast("long").alias("orders"))


def volume_stream(spark: SparkSession, out_root: str, opts: WindowOptions, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """ST-04: per-bucket counts as a query over the cleaning job's ledger."""
    return _start(ledger_stream(spark, out_root), lambda _df, _id: count_pending(spark, out_root, opts) and None, checkpoint, trigger)
