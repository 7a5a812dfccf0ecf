"""Structured Streaming jobs: clean, retrain and counts of a plain stream, each via ``foreachBatch``.

Every micro-batch writes its output under ``epoch=<id>`` with dynamic partition overwrite
(a replayed epoch overwrites itself), and the ledger row for the epoch is written last, as
the commit marker.  Jobs that follow the cleaning job work on committed epochs, see
``committed.py``.  ``trigger(availableNow=True)`` gives the one-shot mode; a restart with
the same checkpoint processes only new input.
"""
from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import quality
from ..operators.ledger import LEDGER_SCHEMA, ledger_rows, quarantine_rows
from ..operators.metrics import bucket_of, epoch
from ..options import QualityOptions, WindowOptions


def _stored(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists, in whatever store its path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _write_epoch(df: DataFrame, path: str, epoch_id: int) -> None:
    (df.withColumn("epoch", F.lit(epoch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(path))


def _start(stream: DataFrame, fn, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


#: Tables of the cleaning job, so that readers of an empty store need no file.
ANNOTATED = ("batch string, batch_time timestamp, pos long, raw_line string, reason string, order_id string, timestamp string, "
             "distance_km string, prep_minutes string, order_value string, was_late string, t_order_id string, t_timestamp string, "
             "t_was_late string, _ts timestamp, _d double, _p long, _v double, epoch long")
LEDGER = LEDGER_SCHEMA + ", epoch long"


def clean_epoch(raw: DataFrame, status: DataFrame | None, out_root: str, epoch_id: int,
                options: QualityOptions | None = None, skip_blank: bool = True) -> None:
    """Clean ``raw`` as epoch ``epoch_id``: annotated rows first, then the ledger rows that commit them.

    ``status`` has a ``skip_reason`` per file: every readable file gets a committed row, also
    without any record (SNK-05), every other one a ``skipped`` row with its reason (ST-08).
    """
    spark = raw.sparkSession
    ann = quality.annotate(raw, options or QualityOptions(), skip_blank=skip_blank)
    out = ann.select("batch", "batch_time", "pos", "raw_line", "reason", "order_id", "timestamp",
                     "distance_km", "prep_minutes", "order_value", "was_late", "t_order_id",
                     "t_timestamp", "t_was_late", "_ts", "_d", "_p", "_v")
    _write_epoch(out, f"{out_root}/annotated", epoch_id)            # rejects + features
    # with the schema given, a micro-batch without rows reads as an empty epoch
    written = spark.read.schema("batch string, reason string, epoch long").parquet(f"{out_root}/annotated")
    stats = quality.batch_stats(written.where(F.col("epoch") == epoch_id).select("batch", "reason"))
    if status is not None:
        done = status.where(F.col("skip_reason").isNull()).select("batch").distinct()
        stats = done.join(stats, "batch", "left").select(
            "batch", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
                       for c in stats.columns if c not in ("batch", "reasons_text")])
    rows = ledger_rows(stats, "clean")
    if status is not None:
        # a file whose name is no batch key is on record under its name
        skipped = status.where(F.col("skip_reason").isNotNull()).select(
            F.when(F.col("batch") != "", F.col("batch")).otherwise(F.col("file")).alias("batch"), F.col("skip_reason").alias("reason"))
        rows = rows.unionByName(quarantine_rows(skipped, "clean"))
    _write_epoch(rows, f"{out_root}/ledger", epoch_id)   # commit marker last


def clean_stream(stream: DataFrame, to_raw: Callable[[DataFrame], DataFrame], out_root: str,
                 checkpoint: str, options: QualityOptions | None = None,
                 trigger: dict | None = None, skip_blank: bool = True) -> StreamingQuery:
    """ST-01: every micro-batch of raw input -> annotated rows (features + rejects) + ledger.

    ``to_raw`` turns the micro-batch into raw lines (``batch, batch_time, pos,
    raw_line``), or into ``(raw lines, file status)`` as ``raw_files.usable_records`` does.
    Skipped files are never retried, because the checkpoint has consumed them.  Duplicates
    are judged per batch inside the micro-batch (ST-14), which is exact because a
    batch file never spans micro-batches.
    """
    def process(batch_df: DataFrame, epoch_id: int) -> None:
        got = to_raw(batch_df)
        raw, status = got if isinstance(got, tuple) else (got, None)
        clean_epoch(raw, status, out_root, epoch_id, options, skip_blank)

    return _start(stream, process, checkpoint, trigger)


def clean_files(spark: SparkSession, path: str, out_root: str, options: QualityOptions | None = None) -> int:
    """The cleaning job without a stream: all files of ``path`` that have no ledger row, as one epoch; how many there were.

    A run that fails before its ledger rows leaves its files pending, and the next run replaces what it wrote.
    """
    from ..sources import raw_files
    ledger = spark.read.schema(LEDGER).parquet(f"{out_root}/ledger") if _stored(spark, f"{out_root}/ledger") \
        else spark.createDataFrame([], LEDGER)
    seen = ledger.select(F.col("batch").alias("seen")).distinct()
    files = raw_files.list_raw_files(spark, path)
    name = F.when(F.col("batch") != "", F.col("batch")).otherwise(F.col("file"))
    fresh = files.join(seen, name == F.col("seen"), "left_anti")
    n = fresh.count()
    if n:
        lines = raw_files.raw_lines(spark, path).join(
            fresh.select(F.col("path").alias("_path")), F.col("_metadata.file_path") == F.col("_path"), "left_semi")
        raw, status = raw_files.usable_records(lines, fresh)
        last = ledger.agg(F.max("epoch")).first()[0]
        clean_epoch(raw, status, out_root, 0 if last is None else last + 1, options)
    return n


def stream_outputs(spark: SparkSession, out_root: str) -> dict[str, DataFrame]:
    """Committed outputs of ``clean_stream``: only epochs that have their ledger rows."""
    ann = spark.read.schema(ANNOTATED).parquet(f"{out_root}/annotated")
    led = spark.read.schema(LEDGER).parquet(f"{out_root}/ledger")
    committed = ann.join(led.select("epoch").distinct(), "epoch", "left_semi")
    # a zero-row or skipped batch has ledger rows but no data rows: the ledger is the record
    return {"features": quality.features(committed), "rejects": quality.rejects(committed), "ledger": led}


def volume_stream(stream: DataFrame, opts: WindowOptions, out_root: str, checkpoint: str,
                  trigger: dict | None = None, ts: str = "timestamp") -> StreamingQuery:
    """ST-09: per-bucket partial counts of a plain stream, merged additively; late rows just add to their bucket.

    No watermark drops anything; the per-bucket table is tiny and the windowed series is a
    query over it.  For sources that deliver a row once: over the cleaning job's
    output use ``committed.volume_stream``.
    """
    def process(batch_df: DataFrame, epoch_id: int) -> None:
        part = batch_df.groupBy(bucket_of(epoch(ts), opts.bucket_seconds).alias("bucket")).agg(
            F.count(F.lit(1)).cast("long").alias("orders"))
        _write_epoch(part, f"{out_root}/bucket_counts", epoch_id)

    return _start(stream, process, checkpoint, trigger)


def merged_bucket_counts(spark: SparkSession, out_root: str) -> DataFrame:
    """The additive merge of all committed partial counts: one row per bucket."""
    return spark.read.parquet(f"{out_root}/bucket_counts").groupBy("bucket").agg(
        F.sum("orders").cast("long").alias("orders"))


#: Attempts of the retraining job: one row per tried state (rows available, newest version number).
ATTEMPTS = "rows_available long, top_version long, status string, detail string, epoch long"


def retrain_attempts(spark: SparkSession, models_dir: str) -> DataFrame:
    """What the retraining job tried: ``published``, a guard's status, or ``error`` with its text.

    The table lies beside the models folder, whose files are read as sidecars.
    """
    path = f"{models_dir.rstrip('/')}-attempts"
    spark.createDataFrame([], ATTEMPTS).write.mode("append").partitionBy("epoch").parquet(path)   # readable before the first attempt
    return spark.read.schema(ATTEMPTS).parquet(path)


def retrain_stream(ledger_stream: DataFrame, ledger_path: str, features_reader: Callable[[], DataFrame],
                   models_dir: str, checkpoint: str, opts=None, trigger: dict | None = None) -> StreamingQuery:
    """ST-02/ML-01: on every new ledger epoch, retrain when ``rows_available - rows_total(latest) >= N``.

    Rows available come from the ledger table (a sum, no data scan); the latest
    published version from the sidecars.  A fit is attempted only when that
    trigger fires.  Every attempt is a row of ``retrain_attempts``, written after it: a guard that
    says no, a fit without finite weights or a failed publish is a status there, and the loop goes on.
    A state (rows available, newest version number) that was tried and published nothing is not tried
    again; the number of a half-published version is never used again, so that state is a new one.
    Publishing is artifact first, sidecar last (the publish marker).
    """
    from datetime import datetime, timezone

    from ..operators import registry, training
    from ..options import TrainOptions
    opts = opts or TrainOptions()
    spark = ledger_stream.sparkSession

    def latest():
        """(rows_total of the newest readable version, highest version number seen anywhere)."""
        side = registry.read_sidecars(spark, models_dir)
        arts = registry.list_artifacts(spark, models_dir)
        r = side.where("readable").agg(F.max_by("rows_total", "version").alias("rt")).first()
        top = registry.next_version(side, arts).first().next_version - 1
        return int(r.rt or 0), int(top)

    def attempt(rows_total: int, version: int) -> tuple[str, str | None]:
        status, fit, metrics, sizes = training.train_once(features_reader(), opts)
        if status != "ready":
            return status, None
        rec = training.registry_record(
            fit, metrics, sizes["rows_total"], sizes["rows_total"] - rows_total, sizes["n_test"],
            sizes.get("data_through"), datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"), opts)
        registry.publish(spark, models_dir, version, fit, rec)
        return "published", f"model_v{version:04d}"

    def process(batch_df: DataFrame, epoch_id: int) -> None:
        available = spark.read.parquet(ledger_path).where(F.col("status") == "committed") \
            .agg(F.sum("kept")).first()[0] or 0
        rows_total, top_version = latest()
        if available - rows_total < opts.retrain_every:
            return
        tried = retrain_attempts(spark, models_dir).where((F.col("rows_available") == available) & (F.col("top_version") == top_version))
        if not tried.isEmpty():
            return
        try:
            status, detail = attempt(rows_total, top_version + 1)      # ML-06: never reuse a number
        except Exception as exc:  # noqa: BLE001 -- kept as a row; the next epoch is another try
            status, detail = "error", f"{type(exc).__name__}: {str(exc)[:500]}"
        done = spark.createDataFrame([(int(available), top_version, status, detail)], "rows_available long, top_version long, status string, detail string")
        _write_epoch(done, f"{models_dir.rstrip('/')}-attempts", epoch_id)

    return _start(ledger_stream, process, checkpoint, trigger)


def watermarked_volume_stream(stream: DataFrame, opts: WindowOptions, out_root: str, checkpoint: str,
                              watermark: str, trigger: dict | None = None, ts: str = "timestamp") -> StreamingQuery:
    """ST-10/11 opt-in: Spark's stateful tumbling-window count with a watermark (update mode).

    State stays bounded by the watermark, at the price the reference never pays:
    rows later than the watermark are dropped.  Each epoch emits the updated
    *cumulative* count of the windows it touched; ``watermarked_counts`` keeps the
    newest value per window.
    """
    counts = (stream.withWatermark(ts, watermark)
              .groupBy(F.window(ts, f"{opts.bucket_minutes} minutes").alias("w"))
              .agg(F.count(F.lit(1)).cast("long").alias("orders"))
              .select(bucket_of(epoch(F.col("w.start")), opts.bucket_seconds).alias("bucket"), "orders"))

    def process(batch_df: DataFrame, epoch_id: int) -> None:
        _write_epoch(batch_df, f"{out_root}/window_counts", epoch_id)

    w = (counts.writeStream.outputMode("update").foreachBatch(process)
         .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})))
    return w.start()


def watermarked_counts(spark: SparkSession, out_root: str) -> DataFrame:
    """Newest emitted count per window (updates are cumulative, so the latest epoch wins)."""
    return spark.read.parquet(f"{out_root}/window_counts").groupBy("bucket").agg(
        F.max_by("orders", "epoch").alias("orders"))


def stop_summary(spark: SparkSession, out_root: str) -> DataFrame:
    """ST-13: files, kept and rejected over everything the cleaning job committed (from its ledger)."""
    led = spark.read.parquet(f"{out_root}/ledger")
    done = led.where(F.col("status") == "committed")
    return done.agg(F.count(F.lit(1)).cast("long").alias("files"), F.sum("kept").cast("long").alias("kept"),
                    F.sum("rejected").cast("long").alias("rejected"),
                    led.where(F.col("status") == "skipped").agg(F.count(F.lit(1))).scalar().cast("long").alias("skipped"))
