"""Time-ordered holdout, readiness guards, fit and evaluation (ML-02..05, AGG-05..11, WIN-03)."""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..options import TrainOptions
from .ordering import order_cutoff


def split_sizes(n: Column, opts: TrainOptions) -> tuple[Column, Column]:
    """``n_test = max(1, round(0.2 n))`` (half-even, as Python's round), ``n_train = n - n_test``."""
    n_test = F.greatest(F.lit(1).cast("long"), F.bround(n * F.lit(opts.test_fraction), 0).cast("long"))
    return n - n_test, n_test


def holdout_cutoff(features: DataFrame, opts: TrainOptions | None = None,
                   order_cols: tuple = ("batch", "pos")) -> tuple:
    """The ``(major, minor)`` key of the last train row, evaluated once.

    ``order_cutoff`` finds it with small aggregates only (the rows are never sorted
    or shuffled for it); the two scalars then come back to the driver, so the split
    is a literal range filter that Parquet row-group statistics can prune, and
    callers can reuse it instead of re-running the nested subqueries.
    ``(None, None)`` when there is no train row.
    """
    opts = opts or TrainOptions()
    major, minor = order_cols
    n = features.agg(F.count(F.lit(1)).cast("long")).scalar()
    n_train, _ = split_sizes(n, opts)
    cut_major, cut_minor = order_cutoff(features, n_train, major, minor)
    row = features.sparkSession.range(1).select(cut_major.alias("m"), cut_minor.alias("p")).first()
    return row["m"], row["p"]


def holdout_split(features: DataFrame, opts: TrainOptions | None = None,
                  order_cols: tuple = ("batch", "pos"), cutoff: tuple | None = None) -> DataFrame:
    """WIN-03: oldest rows train, newest ``test_fraction`` test, in file-name then file order.

    The split is a filter on the ``holdout_cutoff`` key (given, or found here).
    """
    major, minor = order_cols
    cut_major, cut_minor = cutoff if cutoff is not None else holdout_cutoff(features, opts, order_cols)
    if cut_major is None:
        train = F.lit(False)
    else:
        # a plain range predicate on literals (no coalesce), so it reaches the Parquet scan;
        # a NULL comparison falls to 'test' exactly as at_or_before's False would
        train = (F.col(major) < F.lit(cut_major)) | ((F.col(major) == F.lit(cut_major))
                                                     & (F.col(minor) <= F.lit(cut_minor)))
    return features.withColumn("split", F.when(train, F.lit("train")).otherwise(F.lit("test")))


def split_side(cutoff: tuple, side: str, order_cols: tuple = ("batch", "pos")) -> Column:
    """Row filter of one holdout side as a plain range predicate on the cutoff literals.

    Unlike a filter on the ``split`` column, it reaches the Parquet scan, so the
    test side of a table sorted by ``(batch, pos)`` within its files reads only the
    row groups of the newest batches.  The keys are never NULL in the stage table.
    """
    major, minor = order_cols
    cut_major, cut_minor = cutoff
    if cut_major is None:
        return F.lit(side == "test")
    m, p = F.lit(cut_major), F.lit(cut_minor)
    if side == "train":
        return (F.col(major) < m) | ((F.col(major) == m) & (F.col(minor) <= p))
    return (F.col(major) > m) | ((F.col(major) == m) & (F.col(minor) > p))


def readiness(split: DataFrame, opts: TrainOptions | None = None) -> DataFrame:
    """ML-02/AGG-05: enough rows and both labels in the *train* split (a status row, not an exception)."""
    opts = opts or TrainOptions()
    lbl = F.col(opts.label)
    agg = split.agg(F.count(F.lit(1)).cast("long").alias("rows_total"),
                    F.count_if(F.col("split") == "train").cast("long").alias("n_train"),
                    F.count_if(F.col("split") == "test").cast("long").alias("n_test"),
                    F.count_distinct(F.when(F.col("split") == "train", lbl)).alias("train_classes"),
                    F.count_distinct(F.when(F.col("split") == "test", lbl)).alias("test_classes"))
    status = (F.when(F.col("rows_total") < opts.min_rows, F.lit("too_few_rows"))
              .when(F.col("train_classes") < 2, F.lit("one_class_in_train")).otherwise(F.lit("ready")))
    return agg.withColumn("status", status)


def classification_metrics(scored: DataFrame, label: str = "was_late", prob: str = "probability") -> DataFrame:
    """AGG-06..11 on a scored test split; the class decision is ``p > 0.5`` on the *unrounded* p.

    Everything comes from one histogram of distinct scores (positives and negatives
    per score), so the test rows are scanned once: the confusion counts are sums
    over score ranges, and ROC-AUC is the exact tie-aware rank statistic
    ``sum_s pos_s * (2 * neg_below_s + neg_s) / (2 P N)`` in integers (NULL with one
    class).  Ratios of integer counts; zero-division gives 0 like the reference's scorer.
    The histogram is bounded by the model's distinct scores (for the validated
    features: distance at 0.1 km in (0, 50], whole prep minutes in (0, 120] -- at
    most ~60k rows whatever the data size), so its ordered running sum is small.
    """
    y = F.col(label).cast("long")
    hist = scored.groupBy(F.col(prob).alias("s")).agg(F.sum(y).alias("p"), F.sum(1 - y).alias("q"))
    below = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = hist.withColumn("q_below", F.coalesce(F.sum("q").over(below), F.lit(0)))
    flagged = F.col("s") > F.lit(0.5)
    c = ranked.agg(
        F.sum(F.col("p") + F.col("q")).cast("long").alias("n_test"),
        F.sum("p").cast("long").alias("pos"),
        F.sum("q").cast("long").alias("neg"),
        F.coalesce(F.sum(F.when(flagged, F.col("p"))), F.lit(0)).cast("long").alias("tp"),
        F.coalesce(F.sum(F.when(flagged, F.col("q"))), F.lit(0)).cast("long").alias("fp"),
        F.coalesce(F.sum(F.when(~flagged, F.col("p"))), F.lit(0)).cast("long").alias("fn"),
        F.coalesce(F.sum(F.when(~flagged, F.col("q"))), F.lit(0)).cast("long").alias("tn"),
        F.sum(F.col("p") * (F.lit(2) * F.col("q_below") + F.col("q"))).cast("double").alias("auc_num"))
    rate = F.col("pos") / F.col("n_test")

    def safe(num, den):
        return F.coalesce(num / F.when(den != 0, den), F.lit(0.0))

    return c.select(
        "n_test", rate.alias("late_rate_test"),
        F.greatest(rate, F.lit(1.0) - rate).alias("baseline_accuracy"),
        ((F.col("tp") + F.col("tn")) / F.col("n_test")).alias("accuracy"),
        safe(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        safe(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        safe(F.lit(2) * F.col("tp"), F.lit(2) * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
        F.when((F.col("pos") > 0) & (F.col("neg") > 0),
               F.col("auc_num") / (F.lit(2.0) * F.col("pos") * F.col("neg"))).alias("roc_auc"))


def roc_auc(scored: DataFrame, label: str = "was_late", prob: str = "probability") -> Column:
    """Scalar subquery: exact ROC-AUC (see ``classification_metrics``)."""
    return classification_metrics(scored, label, prob).select("roc_auc").scalar()


@dataclass
class FitResult:
    """Weights by feature name: what a published artifact holds."""
    coefficients: dict
    intercept: float
    n_train: int
    iterations: int


def newton_sums(compact: DataFrame, cols: list[str], beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log loss, gradient and Hessian of the weighted rows at ``beta`` (intercept first), as one aggregate.

    The sums are ``1 + k + k(k+1)/2`` numbers for ``k`` weights, combined on the map side, whatever the rows.
    """
    x = [F.lit(1.0), *[F.col(c) for c in cols]]
    z = reduce(add, [F.lit(float(w)) * v for w, v in zip(beta, x, strict=True)])
    rows = compact.select("label", "weight", *cols, z.alias("_z")).withColumn("_p", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_z"))))
    loss = F.greatest(F.col("_z"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("_z"))) - F.col("label") * F.col("_z")
    slope, curve = F.col("weight") * (F.col("_p") - F.col("label")), F.col("weight") * F.col("_p") * (F.lit(1.0) - F.col("_p"))
    upper = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    sums = rows.agg(F.sum(F.col("weight") * loss), *[F.sum(slope * v) for v in x], *[F.sum(curve * x[i] * x[j]) for i, j in upper]).first()
    hessian = np.zeros((len(x), len(x)))
    for (i, j), value in zip(upper, sums[1 + len(x):], strict=True):
        hessian[i, j] = hessian[j, i] = value
    return sums[0], np.array(sums[1:1 + len(x)], dtype=float), hessian


def fit_logistic(train: DataFrame, opts: TrainOptions | None = None) -> FitResult:
    """ML-03: L2 logistic regression on raw (unscaled) features, ``sum(logloss) + |w|^2 / 2``, intercept free.

    Rows are collapsed to distinct (features, label) with a count as their weight, once: the loss is the same, and
    every step then reads a table bounded by the feature domain, not by the data.  A Newton step is one aggregate
    (``newton_sums``) and a solve of as many equations as there are weights.  A step that does not lower the loss
    is halved.  Stops when no weight moves by more than ``opts.tol`` (relative), after ``opts.max_iter`` at the latest.
    """
    opts = opts or TrainOptions()
    cols = list(opts.features)
    compact = train.groupBy(*[F.col(c).cast("double").alias(c) for c in cols],
                            F.col(opts.label).cast("double").alias("label")) \
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    # AQE sizes the aggregate's partitions: a few when the feature domain is small,
    # as many as needed when it is not (no fixed count that a large domain would overflow)
    compact = compact.persist()
    try:
        n_train = int(compact.agg(F.sum("weight")).first()[0] or 0)
        if n_train == 0:
            raise ValueError("no training rows")
        penalty = np.array([0.0] + [1.0] * len(cols))
        beta, best, step, steps = np.zeros(len(cols) + 1), np.inf, np.zeros(len(cols) + 1), 0
        while steps < opts.max_iter:
            steps += 1
            loss, gradient, hessian = newton_sums(compact, cols, beta)
            total = loss + float(penalty @ beta ** 2) / 2
            if not np.isfinite(total) or total > best + 1e-9 * abs(best):
                if np.abs(step).max() <= opts.tol * max(1.0, float(np.abs(beta).max())):
                    break
                step = step / 2
                beta = beta - step
                continue
            best = total
            step = -np.linalg.solve(hessian + np.diag(penalty), gradient + penalty * beta)
            beta = beta + step
            if np.abs(step).max() <= opts.tol * max(1.0, float(np.abs(beta).max())):
                break
    except np.linalg.LinAlgError as exc:
        raise ValueError("no unique weights") from exc
    finally:
        compact.unpersist()
    if not np.isfinite(beta).all():   # ML-05
        raise ValueError("non-finite coefficients")
    return FitResult(dict(zip(cols, beta[1:].tolist(), strict=True)), float(beta[0]), n_train, steps)


def registry_record(fit: FitResult, metrics: dict, rows_total: int, rows_new: int, n_test: int,
                    data_through: str | None, trained_at: str, opts: TrainOptions | None = None) -> dict:
    """ML-07: the registry record of a fitted model, times in ISO form; ``registry.records_frame`` rounds its numbers."""
    opts = opts or TrainOptions()
    if hasattr(data_through, "strftime"):
        data_through = data_through.strftime("%Y-%m-%dT%H:%M:%SZ")
    counts = {"rows_total": rows_total, "rows_new": rows_new, "n_train": fit.n_train, "n_test": n_test,
              "train_every_n_events": opts.retrain_every}
    scores = ("late_rate_test", "baseline_accuracy", "accuracy", "precision", "recall", "f1", "roc_auc")
    return {
        "model_type": "LogisticRegression", "trained_at": trained_at, "data_through": data_through,
        "feature_columns": list(opts.features), "label_column": opts.label,
        **{name: int(n) for name, n in counts.items()},
        **{name: metrics.get(name) for name in scores},
        "coefficients": dict(fit.coefficients), "intercept": fit.intercept,
    }


def train_once(features: DataFrame, opts: TrainOptions | None = None, cutoff: tuple | None = None):
    """ML-02..05: holdout, guards, fit, evaluation.  Returns ``(status, fit, metrics, sizes)``.

    Nothing data-sized is cached: the guards are one aggregate pass, and the fit and
    the evaluation each read only their side of the split (pushed-down range filters).
    """
    from .scoring import logistic
    opts = opts or TrainOptions()
    cut = cutoff if cutoff is not None else holdout_cutoff(features, opts)
    ready = readiness(holdout_split(features, opts, cutoff=cut), opts).first().asDict()
    if ready["status"] != "ready":
        return ready["status"], None, None, ready
    fit = fit_logistic(features.where(split_side(cut, "train")), opts)
    test = features.where(split_side(cut, "test")).withColumn("probability", logistic(fit.coefficients, fit.intercept))
    m = classification_metrics(test, opts.label).first().asDict()
    ready["data_through"] = features.agg(F.max("timestamp")).first()[0]
    return "ready", fit, m, ready
