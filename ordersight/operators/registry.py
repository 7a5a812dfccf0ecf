"""Model registry: versions, sidecars, publishing and the newest usable model.

The registry is a small table (one row per published version, bounded by the
training cadence, never by data volume), so ordered windows over it and
broadcasts of it are safe.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import checkpoint_name

# Sidecar keys, in the order they are rendered.
SIDECAR_KEYS = ("version", "model_file", "model_type", "feature_columns", "label_column",
                "trained_at", "rows_total", "rows_new", "n_train", "n_test", "data_through",
                "late_rate_test", "baseline_accuracy", "accuracy", "precision", "recall", "f1",
                "roc_auc", "coefficients", "intercept", "train_every_n_events")
SIDECAR_NAME_RE = r"^model_v(\d{4,})\.json$"
ARTIFACT_NAME_RE = r"^model_v(\d{4,})$"


def schedule_registry(features: DataFrame, every: Column | None = None,
                      cadence_seconds: int = 86400, train_every: int = 400) -> DataFrame:
    """Registry rows of a retraining cadence replayed over a feature table.

    One version per cadence period that has data (daily by default): ``rows_total``
    = rows available through the period, ``rows_new`` = growth since the previous
    version (WIN-10), ``data_through`` = newest order so far, ``retrain_due`` = the
    ML-01 trigger (``rows_new >= train_every``).  Per-period aggregation first, so
    the ordered windows run over one row per period.
    """
    per = features.groupBy(F.floor(F.unix_seconds("batch_time") / F.lit(cadence_seconds)).cast("long").alias("period")) \
        .agg(F.count(F.lit(1)).cast("long").alias("rows"), F.max("timestamp").alias("newest"))
    w = Window.orderBy("period")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reg = per.select(
        F.row_number().over(w).cast("long").alias("version"),
        F.timestamp_seconds((F.col("period") + 1) * F.lit(cadence_seconds)).alias("trained_at"),
        F.sum("rows").over(upto).cast("long").alias("rows_total"),
        F.max("newest").over(upto).alias("data_through"))
    reg = reg.withColumn("rows_new", (F.col("rows_total") - F.coalesce(F.lag("rows_total").over(Window.orderBy("version")), F.lit(0))).cast("long"))
    return reg.select("version", checkpoint_name(F.col("version")).alias("checkpoint_id"),
                      "trained_at", "data_through", "rows_total", "rows_new",
                      (F.col("rows_new") >= F.lit(train_every)).alias("retrain_due"))


def newest(registry: DataFrame, readable: Column | None = None) -> DataFrame:
    """SRT-02: the highest *version number* among readable entries (never by file time)."""
    r = registry if readable is None else registry.where(readable)
    return r.agg(F.max("version").alias("version")).select(
        "version", checkpoint_name(F.col("version")).alias("checkpoint_id"))


def next_version(*version_frames: DataFrame) -> DataFrame:
    """ML-06: 1 + the highest version seen anywhere (damaged/half-published ones stay reserved)."""
    allv = None
    for df in version_frames:
        v = df.select(F.col("version").cast("long"))
        allv = v if allv is None else allv.unionByName(v)
    return allv.agg((F.coalesce(F.max("version"), F.lit(0)) + 1).cast("long").alias("next_version"))


def retrain_due(rows_available: Column, latest_rows_total: Column, every: int) -> Column:
    """ML-01: retrain when ``rows_available - rows_total(latest published) >= N``."""
    return (rows_available - F.coalesce(latest_rows_total, F.lit(0))) >= F.lit(every)


# ---------- sidecar files ----------

def read_sidecars(spark: SparkSession, models_dir: str) -> DataFrame:
    """SRC-12/15: every ``model_v<N>.json`` with its parsed fields and a ``readable`` flag.

    Files are enumerated from a ``binaryFile`` listing (an empty file yields no text
    row, so listing and content are left-joined).  Readable = valid JSON object with
    an integer-castable ``rows_total``.
    """
    listing = (list_files(spark, models_dir, "model_v*.json")
               .withColumn("file", F.regexp_extract("path", r"([^/]+)$", 1))
               .withColumn("version", F.regexp_extract("file", SIDECAR_NAME_RE, 1).try_cast("long"))
               .where(F.col("version").isNotNull()))
    if listing.isEmpty():
        text = spark.createDataFrame([], "path string, value string")
    else:
        text = (spark.read.option("pathGlobFilter", "model_v*.json").text(models_dir, wholetext=True)
                .select(F.col("_metadata.file_path").alias("path"), F.col("value")))
    j = listing.join(text, "path", "left")
    rows_total = F.get_json_object("value", "$.rows_total").try_cast("long")
    is_object = F.ltrim(F.coalesce(F.col("value"), F.lit(""))).startswith("{")
    return j.select(
        "version", "file", "length",
        (is_object & rows_total.isNotNull()).alias("readable"),
        rows_total.alias("rows_total"),
        F.xxhash64("value").alias("fingerprint"),
        F.get_json_object("value", "$.trained_at").alias("trained_at"),
        F.get_json_object("value", "$.data_through").alias("data_through"),
        F.from_json(F.get_json_object("value", "$.feature_columns"), "array<string>").alias("feature_columns"),
        F.from_json(F.get_json_object("value", "$.coefficients"), "map<string,double>").alias("coefficients"),
        F.get_json_object("value", "$.intercept").try_cast("double").alias("intercept"))


def list_files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """File listing (path, length) of a folder, zero-byte files included.

    Spark's file readers skip empty files, so "published but empty" could not be
    seen from data rows.  The listing is metadata of the models folder (one entry
    per version), taken through the Hadoop FileSystem API.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    pattern = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{glob}")
    fs = pattern.getFileSystem(conf)
    statuses = fs.globStatus(pattern) or []      # None when the folder does not exist yet
    rows = [(str(st.getPath().toString()), int(st.getLen())) for st in statuses if st.isFile()]
    return spark.createDataFrame(rows, "path string, length long")


def unreadable_sidecars(spark: SparkSession, models_dir: str) -> DataFrame:
    """SRC-15: sidecars that do not parse (truncated, not an object, bad ``rows_total``, empty)."""
    return read_sidecars(spark, models_dir).where(~F.col("readable")).select("version", "file", "length")


def list_artifacts(spark: SparkSession, models_dir: str) -> DataFrame:
    """Model artifact folders ``model_v<N>`` whose write was committed."""
    done = list_files(spark, models_dir, "model_v*/_SUCCESS")
    name = F.regexp_extract("path", r"/(model_v\d{4,})/_SUCCESS$", 1)
    return done.select(name.alias("artifact")).where(F.col("artifact") != "").distinct() \
        .withColumn("version", F.regexp_extract("artifact", ARTIFACT_NAME_RE, 1).cast("long"))


def published(sidecars: DataFrame, artifacts: DataFrame) -> DataFrame:
    """JN-07: readable sidecars; loadable only when the artifact is also present."""
    readable = sidecars.where("readable")
    have = artifacts.select("version").distinct()
    return readable.join(have.withColumn("loadable", F.lit(True)), "version", "left") \
        .withColumn("loadable", F.coalesce("loadable", F.lit(False)))


def orphan_artifacts(sidecars: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Artifacts with no readable sidecar (half-published or damaged versions)."""
    return artifacts.join(sidecars.where("readable").select("version"), "version", "left_anti")


def sidecar_json(df: DataFrame) -> DataFrame:
    """SNK-07 as a column: the registry columns as a JSON text, one key per line, in the pinned order; nulls are kept."""
    present = [k for k in SIDECAR_KEYS if k in df.columns]
    text = F.to_json(F.struct(*present), {"pretty": "true", "ignoreNullFields": "false"})
    return df.select("version", text.alias("sidecar"))


ARTIFACT = "position int, feature string, weight double"


def write_artifact(spark: SparkSession, path: str, model) -> None:
    """A model as a table of its own feature names and weights (the intercept has no name); refuses to overwrite."""
    rows = [(-1, None, float(model.intercept)), *[(i, name, float(w)) for i, (name, w) in enumerate(model.coefficients.items())]]
    spark.createDataFrame(rows, ARTIFACT).coalesce(1).write.mode("errorifexists").parquet(path)


def publish(spark: SparkSession, models_dir: str, version: int, model, sidecar: dict) -> None:
    """SNK-04: artifact first (refuses to overwrite), then the sidecar as the publish marker.

    ``model`` has ``coefficients`` (by feature name) and ``intercept``.
    """
    root, name = models_dir.rstrip("/"), f"model_v{version:04d}"
    write_artifact(spark, f"{root}/{name}", model)
    record = records_frame(spark, [{**sidecar, "version": version, "model_file": name}])
    sidecar_json(record).select("sidecar").coalesce(1).write.mode("errorifexists").text(f"{root}/_{name}.json.d")
    # move the single part file into place as model_v<N>.json (the marker)
    _promote_single_file(spark, f"{root}/_{name}.json.d", f"{root}/{name}.json")


def _promote_single_file(spark: SparkSession, src_dir: str, dst: str) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(src_dir)
    fs = path.getFileSystem(conf)
    parts = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError("sidecar write produced no single file")
    target = jvm.org.apache.hadoop.fs.Path(dst)
    if fs.exists(target):
        raise FileExistsError(dst)
    if not fs.rename(parts[0], target):
        raise RuntimeError(f"could not move the sidecar to {dst}")
    fs.delete(path, True)


# ---------- load, validate, choose (ML-08/09, SRT-04) ----------

def load_checkpoint(spark: SparkSession, models_dir: str, version: int, sidecar_features: list | None):
    """ML-08: load ``model_v<N>`` and validate it; returns ``(coefficients, intercept, None)`` or
    ``(None, None, reason)``.  Checks: the artifact loads, its feature names are not empty and equal the
    registry's in the same order, and all its weights are finite."""
    try:
        rows = spark.read.schema(ARTIFACT).parquet(f"{models_dir.rstrip('/')}/model_v{version:04d}").orderBy("position").collect()   # one row per weight
    except Exception as exc:  # noqa: BLE001 -- any unreadable artifact is a skip, not a crash
        return None, None, f"unreadable artifact ({type(exc).__name__})"
    weights = {r.feature: r.weight for r in rows if r.position is not None and r.position >= 0}
    bias = [r.weight for r in rows if r.position == -1]
    feats = list(sidecar_features or [])
    if not feats or any(not isinstance(f, str) or not f for f in feats):
        return None, None, "no feature columns"
    if len(bias) != 1 or len(weights) + 1 != len(rows):
        return None, None, "unreadable artifact (rows)"
    if list(weights) != feats:
        return None, None, "feature columns differ from the artifact"
    if any(w is None or not math.isfinite(w) for w in [*bias, *weights.values()]):
        return None, None, "non-finite probe"
    return weights, bias[0], None


def choose_model(candidates: list, current: int | None, bad: set) -> int | None:
    """ML-09/SRT-04: newest loadable version greater than the current one; fall back downwards
    over newer candidates that failed; keep the current model when nothing newer loads.

    A current version that is no longer published (the registry was reset) counts as none, so the
    newest loadable one is taken even if its number is smaller.
    ``candidates`` are the (tiny) published registry rows as ``(version, loadable)``.
    """
    if current not in {v for v, _ in candidates}:
        current = None
    newer = sorted((v for v, ok in candidates if ok and v not in bad and (current is None or v > current)),
                   reverse=True)
    if newer:
        return newer[0]
    return current


def records_frame(spark: SparkSession, records: list) -> DataFrame:
    """Registry rows as a typed table: ``feature_columns`` ARRAY<STRING>, ``coefficients`` MAP (MAP-01)."""
    kinds = dict.fromkeys(SIDECAR_KEYS, "double") | dict.fromkeys(
        ("model_file", "model_type", "trained_at", "data_through", "label_column"), "string") | dict.fromkeys(
        ("version", "rows_total", "rows_new", "n_train", "n_test", "train_every_n_events"), "long") | {
        "feature_columns": "array<string>", "coefficients": "map<string,double>"}
    rows = [tuple(r.get(k) for k in SIDECAR_KEYS) for r in records]
    # weights in the order of the features
    in_order = F.when(F.col("coefficients").isNotNull(), F.map_from_arrays(
        "feature_columns", F.transform("feature_columns", lambda name: F.round(F.col("coefficients")[name], 3))))
    rounded = {k: F.round(k, 3) for k, kind in kinds.items() if kind == "double"}
    return spark.createDataFrame(rows, ", ".join(f"{k} {kinds[k]}" for k in SIDECAR_KEYS)).withColumns(
        rounded | {"coefficients": in_order})


class ModelChooser:
    """ML-09: per micro-batch, the newest loadable published model (hot swap at batch boundaries).

    A version is known by its number and its sidecar's fingerprint.  Keeps the current one and those that
    failed to load, so a damaged newest version is skipped (and remembered) and the scorer falls back to the
    next one down.  A current version that is gone, or published anew under its number, counts as a reset
    registry: the newest loadable version is loaded, whatever its number (ST-15).
    """

    def __init__(self, spark: SparkSession, models_dir: str):
        self.spark, self.models_dir = spark, models_dir
        self.current: tuple | None = None
        self.bad: set = set()
        self.loaded: tuple | None = None

    def __call__(self) -> tuple[dict, float, str] | None:
        side = read_sidecars(self.spark, self.models_dir)
        arts = list_artifacts(self.spark, self.models_dir)
        pub = {r.version: r for r in published(side, arts).select("version", "loadable", "feature_columns", "fingerprint").collect()}   # tiny
        known = {(v, r.fingerprint) for v, r in pub.items()}
        if self.current not in known:
            self.current, self.loaded = None, None
        self.bad &= known
        candidates = [(v, r.loadable) for v, r in pub.items()]
        while True:
            choice = choose_model(candidates, self.current and self.current[0], {v for v, _ in self.bad})
            if choice is None:
                return None
            name = (choice, pub[choice].fingerprint)
            if name == self.current:
                return self.loaded
            coefs, icpt, why = load_checkpoint(self.spark, self.models_dir, choice, pub[choice].feature_columns)
            if why is None:
                self.current, self.loaded = name, (coefs, icpt, f"model_v{choice:04d}")
                return self.loaded
            self.bad.add(name)                        # reported once, never retried
