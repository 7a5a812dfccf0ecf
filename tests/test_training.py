"""Holdout, metrics and the logistic fit, each against an independent pure-Python/numpy oracle."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordersight.operators import training
from ordersight.operators.ordering import at_or_before, global_position, order_cutoff


def training_rows(n, seed=7, single_class=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        d = round(rng.uniform(0.5, 12), 1)
        p = rng.randint(5, 30)
        y = 0 if single_class else int(p + 3 * d + rng.gauss(0, 4) > 30)
        rows.append((f"b{i // 10:04d}", i, d, p, y))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "batch string, pos long, distance_km double, prep_minutes int, was_late int")


def newton_oracle(x, y, C=1.0, iters=50):
    """Minimise 1/2 |w|^2 + C * sum logloss, intercept unpenalised (the reference's objective)."""
    X = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(X.shape[1])
    reg = np.diag([0.0] + [1.0] * x.shape[1])
    for _ in range(iters):
        p = 1 / (1 + np.exp(-X @ beta))
        g = C * X.T @ (p - y) + reg @ beta
        H = C * (X.T * (p * (1 - p))) @ X + reg
        beta -= np.linalg.solve(H, g)
    return beta


def test_cutoff_matches_brute_force_with_a_hot_batch(spark):
    rng = random.Random(3)
    rows = [("hot", rng.randrange(1 << 40), 0.0, 0, 0) for _ in range(3000)]      # one batch holds most rows
    rows += [(f"b{i % 17}", 1_000_000 + i, 0.0, 0, 0) for i in range(500)]
    rows = list({(b, p): (b, p, d, q, y) for b, p, d, q, y in rows}.values())
    df = frame(spark, rows)
    order = sorted((b, p) for b, p, *_ in rows)
    for k in (1, 17, 1200, 2999, len(rows)):
        cm, cp = order_cutoff(df, F.lit(k), shift=12)
        got = df.where(at_or_before(F.col("batch"), F.col("pos"), cm, cp)).count()
        assert got == k
        assert df.select(cm.alias("m"), cp.alias("p")).first() == tuple(order[k - 1])


def test_global_position_exact(spark):
    rows = training_rows(500)
    df = frame(spark, rows)
    got = {(r.batch, r.pos): r.position for r in global_position(df, ["batch", "pos"], 5).collect()}
    want = {k: i for i, k in enumerate(sorted((b, p) for b, p, *_ in rows))}
    assert got == want


@pytest.mark.parametrize("n", [49, 50, 99, 100, 150])
def test_time_holdout_sizes(spark, n):
    split = training.holdout_split(frame(spark, training_rows(n)))
    counts = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    n_test = max(1, round(0.2 * n))
    assert counts == {"train": n - n_test, "test": n_test}
    # the newest rows are the test rows
    test_pos = sorted(r.pos for r in split.where("split = 'test'").collect())
    assert test_pos == list(range(n - n_test, n))


def test_guards(spark):
    r = training.readiness(training.holdout_split(frame(spark, training_rows(49)))).first()
    assert r.status == "too_few_rows"
    r = training.readiness(training.holdout_split(frame(spark, training_rows(200, single_class=True)))).first()
    assert r.status == "one_class_in_train"


def test_fit_matches_newton_and_learns(spark):
    rows = training_rows(2000)
    df = frame(spark, rows)
    split = training.holdout_split(df)
    train = split.where("split = 'train'")
    fit = training.fit_logistic(train)
    tr = sorted(rows, key=lambda r: (r[0], r[1]))[:fit.n_train]
    x = np.array([[r[2], r[3]] for r in tr], dtype=float)
    y = np.array([r[4] for r in tr], dtype=float)
    beta = newton_oracle(x, y)
    assert fit.intercept == pytest.approx(beta[0], abs=1e-6)
    assert fit.coefficients["distance_km"] == pytest.approx(beta[1], abs=1e-6)
    assert fit.coefficients["prep_minutes"] == pytest.approx(beta[2], abs=1e-6)
    from ordersight.operators.scoring import logistic
    m = training.classification_metrics(split.where("split = 'test'").withColumn(
        "probability", logistic(fit.coefficients, fit.intercept))).first()
    assert m.accuracy >= m.baseline_accuracy + 0.10 and m.roc_auc >= 0.75


def test_fit_on_separable_constant_and_empty_rows(spark):
    """Far-off and separable rows converge (steps are halved where the loss rises); a column that says nothing gets no weight."""
    rows = [("b", i, 1000.0 * i, 7, int(i >= 20)) for i in range(40)]
    fit = training.fit_logistic(frame(spark, rows))
    x, y = np.array([[r[2], r[3]] for r in rows]), np.array([r[4] for r in rows], float)
    z = fit.intercept + x @ np.array([fit.coefficients["distance_km"], fit.coefficients["prep_minutes"]])
    p = 1 / (1 + np.exp(-z))
    slope = np.column_stack([np.ones(len(x)), x]).T @ (p - y) + np.array([0.0, *fit.coefficients.values()])
    assert np.abs(slope / np.array([1.0, x[:, 0].max(), 7.0])).max() < 1e-6        # the optimum's condition
    assert fit.coefficients["prep_minutes"] == pytest.approx(0.0, abs=1e-6)
    with pytest.raises(ValueError):
        training.fit_logistic(frame(spark, rows).limit(0))


def test_metrics_against_python(spark):
    rng = random.Random(11)
    data = [(round(rng.random(), 2), rng.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(data, "probability double, was_late int")
    m = training.classification_metrics(df).first()
    pos = [p for p, y in data if y == 1]
    neg = [p for p, y in data if y == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    tp = sum(1 for p, y in data if p > 0.5 and y == 1)
    fp = sum(1 for p, y in data if p > 0.5 and y == 0)
    fn = sum(1 for p, y in data if p <= 0.5 and y == 1)
    assert m.roc_auc == pytest.approx(auc, abs=1e-12)
    assert m.precision == pytest.approx(tp / (tp + fp)) and m.recall == pytest.approx(tp / (tp + fn))
    one = training.classification_metrics(spark.createDataFrame([(0.3, 1), (0.8, 1)], "probability double, was_late int")).first()
    assert one.roc_auc is None and one.precision == 1.0
