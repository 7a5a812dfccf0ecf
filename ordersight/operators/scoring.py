"""Scoring: one model per batch, whatever feature columns it lists.

Fast path: the logistic model is a handful of coefficients, so scoring is a
column expression (fully codegen'd, no Python, no model shipped to executors).
``score_with_pandas`` is the extension surface for any object with
``predict_proba`` (Arrow batches through ``mapInPandas``, model broadcast once).
"""
from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import checkpoint_name
from ..options import SCORE_THRESHOLD

# Fixed golden scorer: coefficients and intercept of the reference's contract tests.
GOLDEN_COEFFICIENTS = {"distance_km": 0.6, "prep_minutes": 0.25}
GOLDEN_INTERCEPT = -7.0

PREDICTION_COLUMNS = ("order_id", "late_probability", "predicted_late", "checkpoint_id")


def logistic(coefficients: Mapping[str, float], intercept: float) -> Column:
    """MTH-02: ``1 / (1 + exp(-(b + sum w_i x_i)))`` as a column expression."""
    z = F.lit(float(intercept))
    for name, weight in coefficients.items():
        z = z + F.lit(float(weight)) * F.col(name).cast("double")
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def decide(probability: Column) -> tuple[Column, Column]:
    """FLT-13 + MTH-03: publish the 3-dp probability and decide on the *rounded* value."""
    rounded = F.round(probability, 3)
    return rounded, (rounded >= F.lit(SCORE_THRESHOLD)).cast("int")


def score_fixed(features: DataFrame, coefficients: Mapping[str, float], intercept: float,
                checkpoint_id: str | Column, keep: tuple = ("batch", "pos")) -> DataFrame:
    """ML-10: predictions for every feature row, input order kept through ``pos``."""
    missing = [c for c in coefficients if c not in features.columns]
    if missing:   # FLT-12: a model asking for columns the table lacks cannot score it
        raise ValueError(f"missing column {', '.join(missing)}")
    prob, flag = decide(logistic(coefficients, intercept))
    ck = F.lit(checkpoint_id) if isinstance(checkpoint_id, str) else checkpoint_id
    return features.select("order_id", prob.alias("late_probability"), flag.alias("predicted_late"),
                           ck.alias("checkpoint_id"), *[c for c in keep if c in features.columns])


def score_by_version(features: DataFrame, models: DataFrame, version_of_row: Column,
                     feature_cols: tuple = ("distance_km", "prep_minutes")) -> DataFrame:
    """Score each row with the model version assigned to it (hot swap at batch boundaries).

    ``models`` is the registry: one row per version with ``intercept`` and a
    ``coefficients`` map.  It has one row per published version (bounded by the
    model cadence, not by data); Spark broadcasts it as long as its size allows.
    """
    m = models.select("version", "intercept", "coefficients")
    j = features.withColumn("version", version_of_row).join(m, "version", "inner")
    z = F.col("intercept")
    for c in feature_cols:
        z = z + F.coalesce(F.col("coefficients")[c], F.lit(0.0)) * F.col(c).cast("double")
    prob, flag = decide(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
    return j.select("order_id", prob.alias("late_probability"), flag.alias("predicted_late"),
                    checkpoint_name(F.col("version")).alias("checkpoint_id"), "batch", "pos")


def scored_per_batch(predictions: DataFrame) -> DataFrame:
    """AGG-12: scored orders and predicted-late count per batch."""
    return predictions.groupBy("batch").agg(F.count(F.lit(1)).cast("long").alias("scored"),
                                            F.sum("predicted_late").cast("long").alias("flagged"))


def score_with_pandas(features: DataFrame, model, feature_cols: list[str], checkpoint_id: str,
                      keep: tuple = ("batch", "pos")) -> DataFrame:
    """UDF-01: any object with ``predict_proba(X) -> n x 2`` scores Arrow batches via ``mapInPandas``."""
    import numpy as np

    spark = features.sparkSession
    shipped = spark.sparkContext.broadcast(model)
    keep = [c for c in keep if c in features.columns]
    cols = ["order_id", *feature_cols, *keep]

    def run(batches):
        import pandas as pd
        m = shipped.value
        for pdf in batches:
            x = pdf[feature_cols].to_numpy(dtype="float64")
            p = m.predict_proba(x)[:, 1] if len(pdf) else np.zeros(0)
            if not np.all(np.isfinite(p)):
                raise ValueError("model produced a non-finite probability")
            out = pd.DataFrame({"order_id": pdf["order_id"], "late_probability": p})
            for c in keep:
                out[c] = pdf[c]
            yield out

    probs = features.select(*cols).mapInPandas(
        run, "order_id string, late_probability double" + "".join(
            f", {c} {dict(features.dtypes)[c]}" for c in keep))
    prob, flag = decide(F.col("late_probability"))
    return probs.select("order_id", prob.alias("late_probability"), flag.alias("predicted_late"),
                        F.lit(checkpoint_id).alias("checkpoint_id"), *keep)


class CoefficientModel:
    """A picklable ``predict_proba`` model from coefficients (for the pandas path and tests)."""

    def __init__(self, coefficients: Mapping[str, float], intercept: float, columns: list[str]):
        self.w = [float(coefficients[c]) for c in columns]
        self.b = float(intercept)
        self.feature_names_in_ = list(columns)

    def predict_proba(self, x):
        import numpy as np
        z = self.b + x @ np.asarray(self.w)
        p = 1.0 / (1.0 + np.exp(-z))
        return np.column_stack([1.0 - p, p])
