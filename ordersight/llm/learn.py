"""Fitting on a bounded, hash-chosen sample of labelled rows; FTRL-proximal logistic regression.

Feature vectors are made where the rows lie; the sample's vectors meet in one task, which fits the model
and returns it as one binary value.  ``max_train`` bounds the rows (in expectation: ids are chosen by hash).
"""
from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, sampled, small_batches, texts_of


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
             usable: Callable[[Column], Column], max_train: int, salt: str) -> DataFrame:
    """id, text, label of at most about ``max_train`` labelled rows that ``usable(id)`` admits.

    Both sides are cut by the same hash of the id before they meet, so only the sample is shuffled.  Null
    ids, null texts and null labels are left out; of several labels of an id the largest counts.
    """
    ids = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).dropna()
    ids = ids.filter(usable(F.col("id")))
    n = ids.count()
    share = max_train / max(1, n)
    ids = ids.filter(sampled(F.col("id"), share, salt)).groupBy("id").agg(F.max("label").alias("label"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).dropna()
    texts = texts.filter(usable(F.col("id")) & sampled(F.col("id"), share, salt))
    return texts.join(ids, "id")


def fit_in_one_task(sample: DataFrame, schema: str, prepare: Callable, fit: Callable):
    """``fit(rows)`` over the rows that ``prepare`` (on Arrow batches) makes of the bounded sample; its result.

    The rows are sorted by a hash of the id, so that the fit does not depend on how they were partitioned.
    """
    rows = map_batches(sample.withColumn("order", F.xxhash64(F.col("id").cast("string"), F.lit("order"))), prepare, schema)
    small_batches(sample.sparkSession)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [r for b in batches for r in b.to_pylist()]
        got.sort(key=lambda r: r["order"])
        blob = pickle.dumps(fit(got), protocol=4)
        yield pa.RecordBatch.from_arrays([pa.array([blob], pa.large_binary())], names=["model"])

    (row,) = rows.repartition(1).mapInArrow(train, "model binary").collect()
    return pickle.loads(row["model"])


def vectors(featurise: Callable[[str], tuple[np.ndarray, np.ndarray]]) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """Arrow batches (id, text, label, order) to (order, label, features, values as bytes)."""
    def prepare(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [featurise(t) for t in texts_of(batch, "text")]
        return pa.RecordBatch.from_arrays(
            [batch.column("order"), batch.column("label").cast(pa.int32()),
             pa.array([f.astype(np.int32).tobytes() for f, _ in made], pa.binary()),
             pa.array([v.astype(np.float32).tobytes() for _, v in made], pa.binary())],
            names=["order", "label", "features", "values"])
    return prepare


VECTORS = "order long, label int, features binary, values binary"


def ftrl(rows: list[dict], size: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.0, l2: float = 1e-3,
         epochs: int = 3, positive: float = 1.0,
         bias: float | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression by follow-the-regularised-leader updates.

    Per coordinate: z collects gradients minus the pull of earlier steps, n their squares; a weight is zero
    while |z| <= l1.  ``positive`` weighs the rows of label 1; ``bias`` fixes the bias.  No rows, or one class only: zero weights and the bias of the smoothed class share.
    """
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    data = [(np.append(np.frombuffer(r["features"], np.int32), size),
             np.append(np.frombuffer(r["values"], np.float32).astype(np.float64), 1.0), float(r["label"] == 1)) for r in rows]
    classes = {y for _, _, y in data}
    if len(classes) < 2:
        share = (sum(y for _, _, y in data) + 1) / (len(data) + 2)
        return np.zeros(size, np.float32), float(np.log(share / (1 - share)))

    def weights(f):
        free = np.where(f == size, 0.0, l1)  # the bias is not regularised
        zf, nf = z[f], n[f]
        w = np.where(np.abs(zf) <= free, 0.0, -(zf - np.sign(zf) * free) / ((beta + np.sqrt(nf)) / alpha + np.where(f == size, 0.0, l2)))
        return w if bias is None else np.where(f == size, bias, w)

    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(data)):
            f, x, y = data[k]
            w = weights(f)
            g = (1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x * (positive if y else 1.0)
            sigma = (np.sqrt(n[f] + g * g) - np.sqrt(n[f])) / alpha
            z[f] += g - sigma * w
            n[f] += g * g
    w = weights(np.arange(size + 1))
    return w[:size].astype(np.float32), float(w[size])


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def scored(df: DataFrame, id_col: str, text_col: str, score: Callable[[list[str]], np.ndarray]) -> DataFrame:
    """id_col, score double, predicted int of every row; ``score`` gets the texts of a batch."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = np.asarray(score(texts_of(batch, "_text")), np.float64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                          names=[id_col, "score", "predicted"])

    return map_batches(df.select(F.col(id_col), F.col(text_col).alias("_text")), run, f"`{id_col}` {kind}, score double, predicted int")
