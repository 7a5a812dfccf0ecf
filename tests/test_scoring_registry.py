"""Scoring contract, threshold edges, hot swap and the sidecar registry."""
import json

import pytest
from pyspark.sql import functions as F

from ordersight.operators import registry, scoring


def test_threshold_uses_rounded_probability(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 0.4996, 0.4994, 0.0001, 0.9999)], "p double")
    prob, flag = scoring.decide(F.col("p"))
    got = [(r.lp, r.fl) for r in df.select(prob.alias("lp"), flag.alias("fl")).collect()]
    assert got == [(0.5, 1), (0.5, 1), (0.499, 0), (0.0, 0), (1.0, 1)]


def test_fixed_scorer_and_dynamic_columns(spark):
    f = spark.createDataFrame([("a", 5.0, 16, 99.0, "b", 1)],
                              "order_id string, distance_km double, prep_minutes int, order_value double, batch string, pos long")
    p = scoring.score_fixed(f, scoring.GOLDEN_COEFFICIENTS, scoring.GOLDEN_INTERCEPT, "model_v0001").first()
    assert p.late_probability == pytest.approx(0.5) and p.predicted_late == 1
    # a model may list only some columns; other columns are ignored
    q = scoring.score_fixed(f, {"prep_minutes": 0.25}, -4.0, "model_v0002").first()
    assert q.late_probability == 0.5
    with pytest.raises(ValueError):
        scoring.score_fixed(f, {"weather": 1.0}, 0.0, "model_v0003")


def test_pandas_scorer_equals_expression(spark):
    f = spark.createDataFrame([(f"o{i}", i / 10, i % 30, "b", i) for i in range(200)],
                              "order_id string, distance_km double, prep_minutes int, batch string, pos long")
    m = scoring.CoefficientModel(scoring.GOLDEN_COEFFICIENTS, scoring.GOLDEN_INTERCEPT, ["distance_km", "prep_minutes"])
    a = scoring.score_with_pandas(f, m, ["distance_km", "prep_minutes"], "model_v0001").orderBy("pos").collect()
    b = scoring.score_fixed(f, scoring.GOLDEN_COEFFICIENTS, scoring.GOLDEN_INTERCEPT, "model_v0001").orderBy("pos").collect()
    assert [(r.late_probability, r.predicted_late) for r in a] == [(r.late_probability, r.predicted_late) for r in b]


def write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_sidecars_readable_and_newest_by_number(spark, tmp_dir):
    good = {"rows_total": 400, "trained_at": "2024-05-01T12:00:00Z", "feature_columns": ["distance_km", "prep_minutes"],
            "coefficients": {"distance_km": 0.6, "prep_minutes": 0.25}, "intercept": -7.0}
    write(f"{tmp_dir}/model_v0002.json", json.dumps(good))
    write(f"{tmp_dir}/model_v0010.json", json.dumps({**good, "rows_total": "12"}))
    write(f"{tmp_dir}/model_v0011.json", '{"rows_total": ')          # truncated
    write(f"{tmp_dir}/model_v0012.json", "[]")
    write(f"{tmp_dir}/model_v0013.json", json.dumps({"rows_total": "many"}))
    write(f"{tmp_dir}/model_v0014.json", "")                          # empty: no text row, still listed
    write(f"{tmp_dir}/notes.json", "{}")
    side = registry.read_sidecars(spark, tmp_dir)
    got = {r.version: r.readable for r in side.collect()}
    assert got == {2: True, 10: True, 11: False, 12: False, 13: False, 14: False}
    assert registry.newest(side, F.col("readable")).first().checkpoint_id == "model_v0010"
    assert registry.next_version(side).first().next_version == 15
    coefs = side.where("version = 2").first().coefficients
    assert coefs == {"distance_km": 0.6, "prep_minutes": 0.25}


def test_sidecar_text(spark):
    rec = {"version": 3, "rows_total": 10, "accuracy": 0.81249, "coefficients": {"b": 0.12345, "a": -2.0}, "feature_columns": ["b", "a"], "intercept": 1.0005}
    text = registry.sidecar_json(registry.records_frame(spark, [rec])).first().sidecar
    got = json.loads(text)
    assert list(got) == list(registry.SIDECAR_KEYS)                     # pinned order, undefined values kept
    assert sum(line.startswith('  "') for line in text.split("\n")) == len(registry.SIDECAR_KEYS)   # one key per line
    assert got["accuracy"] == 0.812 and got["coefficients"] == {"b": 0.123, "a": -2.0} and list(got["coefficients"]) == ["b", "a"]
    assert got["f1"] is None and got["feature_columns"] == ["b", "a"]


def _fit(coefficients, intercept=-7.0):
    from ordersight.operators.training import FitResult
    return FitResult(coefficients, intercept, 10, 1)


def test_swapped_names_and_unfit_weights_are_refused(spark, tmp_dir):
    names = ["distance_km", "prep_minutes"]
    registry.publish(spark, tmp_dir, 1, _fit({"distance_km": 0.6, "prep_minutes": 0.25}), {"rows_total": 1, "feature_columns": names})
    assert registry.load_checkpoint(spark, tmp_dir, 1, names) == ({"distance_km": 0.6, "prep_minutes": 0.25}, -7.0, None)
    assert registry.load_checkpoint(spark, tmp_dir, 1, names[::-1])[2] == "feature columns differ from the artifact"
    assert registry.load_checkpoint(spark, tmp_dir, 1, ["distance_km", "hour"])[2] == "feature columns differ from the artifact"
    assert registry.load_checkpoint(spark, tmp_dir, 1, [])[2] == "no feature columns"
    registry.publish(spark, tmp_dir, 2, _fit({"distance_km": float("nan")}), {"rows_total": 1, "feature_columns": ["distance_km"]})
    assert registry.load_checkpoint(spark, tmp_dir, 2, ["distance_km"])[2] == "non-finite probe"
    write(f"{tmp_dir}/model_v0003", "no model")
    assert registry.load_checkpoint(spark, tmp_dir, 3, names)[2].startswith("unreadable artifact")


def test_reset_registry_is_followed_down(spark, tmp_dir):
    """ST-15: 5 loaded, then only 1 and 2 published: 2 is loaded; a version published anew is loaded anew."""
    import shutil
    assert registry.choose_model([(1, True), (2, True)], 5, set()) == 2
    assert registry.choose_model([], 5, set()) is None
    side = {"rows_total": 1, "feature_columns": ["prep_minutes"]}
    old, new = f"{tmp_dir}/old", f"{tmp_dir}/new"
    registry.publish(spark, old, 5, _fit({"prep_minutes": 0.5}), side)
    chooser = registry.ModelChooser(spark, old)
    assert chooser() == ({"prep_minutes": 0.5}, -7.0, "model_v0005")
    chooser.models_dir = new
    assert chooser() is None
    registry.publish(spark, new, 1, _fit({"prep_minutes": 0.1}), side)
    registry.publish(spark, new, 2, _fit({"prep_minutes": 0.2}), side)
    assert chooser() == ({"prep_minutes": 0.2}, -7.0, "model_v0002")
    registry.publish(spark, new, 3, _fit({"prep_minutes": float("inf")}), side)
    assert chooser()[2] == "model_v0002" and {v for v, _ in chooser.bad} == {3}
    again = f"{tmp_dir}/again"
    registry.publish(spark, again, 2, _fit({"prep_minutes": 0.9}), {**side, "rows_total": 2})
    chooser.models_dir = again
    assert chooser() == ({"prep_minutes": 0.9}, -7.0, "model_v0002")
    shutil.rmtree(f"{again}/model_v0002")                                    # the artifact is gone, its sidecar is not
    assert registry.ModelChooser(spark, again)() is None


def test_retrain_trigger_at_n_not_before(spark):
    df = spark.createDataFrame([(399, 0), (400, 0), (800, 400), (799, 400)], "avail long, total long")
    got = [r.d for r in df.select(registry.retrain_due(F.col("avail"), F.col("total"), 400).alias("d")).collect()]
    assert got == [False, True, True, False]
