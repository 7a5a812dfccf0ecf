"""Batch guards, CSV export, model publish/load/validate and the model chooser."""
import glob
import os

import pytest
from pyspark.sql import functions as F

from ordersight.operators import guards, registry
from ordersight.sources import export


def test_one_bad_row_skips_the_batch(spark):
    rows = [("b1", 1, "3.2", "15", "1"), ("b1", 2, " 3.2", "12.5", "0"), ("b1", 3, "abc", "15", "1"),
            ("b2", 1, "3.2", "18.0", "0"), ("b3", 1, "3.2", "15", " 1")]      # untrimmed label is unusable
    df = spark.createDataFrame(rows, "batch string, pos long, distance_km string, prep_minutes string, was_late string")
    g = guards.batch_guard(df, guards.usable_training_row(F.col("distance_km"), F.col("prep_minutes"),
                                                          F.col("was_late")), "unusable row")
    got = {r.batch: (r.usable, r.first_bad_pos) for r in g.collect()}
    assert got == {"b1": (False, 3), "b2": (True, None), "b3": (False, 1)}
    assert [r.batch for r in guards.keep_usable(df, g).collect()] == ["b2"]
    assert guards.required_columns(df, ["distance_km", "hour"]) == ["hour"]


def test_export_features_text_formats(spark, tmp_dir):
    f = spark.createDataFrame([("A", "2024-05-01 12:30:00", 12, 1, 3.0, 15, 25.5, 1, "k1", 2),
                               ("B", "2024-05-01 12:31:00", 12, 1, 0.04, 7, 8.0, 0, "k1", 1)],
                              "order_id string, ts string, hour int, is_peak int, distance_km double, prep_minutes int, "
                              "order_value double, was_late int, batch string, pos long") \
        .withColumn("timestamp", F.to_timestamp("ts")).drop("ts")
    export.export_features(f, f"{tmp_dir}/features")
    files = glob.glob(f"{tmp_dir}/features/batch=k1/*.csv")
    text = "".join(open(p, newline="").read() for p in sorted(files))
    lines = [ln for ln in text.split("\r\n") if ln and not ln.startswith("order_id")]
    assert lines == ["B,2024-05-01T12:31:00Z,12,1,0.0,7,8.00,0,1", "A,2024-05-01T12:30:00Z,12,1,3.0,15,25.50,1,2"]
    with pytest.raises(Exception):
        export.export_features(f, f"{tmp_dir}/features")         # never overwrite an export


def test_publish_load_choose(spark, tmp_dir):
    from ordersight.operators.training import FitResult
    model = FitResult({"distance_km": 0.6, "prep_minutes": 0.25}, -7.0, 99, 5)
    side = {"rows_total": 99, "feature_columns": ["distance_km", "prep_minutes"]}
    registry.publish(spark, tmp_dir, 1, model, side)
    registry.publish(spark, tmp_dir, 2, model, {**side, "feature_columns": ["distance_km"]})   # mismatched list
    registry.write_artifact(spark, f"{tmp_dir}/model_v0003", model)                          # artifact, no sidecar
    with pytest.raises(Exception):
        registry.publish(spark, tmp_dir, 1, model, side)                                   # refuses overwrite
    sidecars = registry.read_sidecars(spark, tmp_dir)
    arts = registry.list_artifacts(spark, tmp_dir)
    pub = {r.version: r.loadable for r in registry.published(sidecars, arts).collect()}
    assert pub == {1: True, 2: True}
    assert [r.version for r in registry.orphan_artifacts(sidecars, arts).collect()] == [3]
    assert registry.next_version(sidecars, arts).first().next_version == 4
    coefs, icpt, why = registry.load_checkpoint(spark, tmp_dir, 1, ["distance_km", "prep_minutes"])
    assert why is None and set(coefs) == {"distance_km", "prep_minutes"}
    assert registry.load_checkpoint(spark, tmp_dir, 2, ["distance_km"])[2] == "feature columns differ from the artifact"
    assert registry.load_checkpoint(spark, tmp_dir, 9, ["distance_km"])[2].startswith("unreadable artifact")
    # newest loadable newer than current; fall back past a known-bad one; keep current otherwise
    assert registry.choose_model([(1, True), (2, True)], None, set()) == 2
    assert registry.choose_model([(1, True), (2, True), (3, True)], 1, {3}) == 2
    assert registry.choose_model([(1, True), (2, False)], 1, set()) == 1


def test_subset_check_and_sidecar_json(spark):
    from ordersight.operators import ledger
    prev = spark.createDataFrame([("a",), ("b",)], "batch string")
    assert ledger.subset_check(prev, spark.createDataFrame([("a",), ("b",), ("c",)], "batch string")).first().append_only
    assert not ledger.subset_check(prev, spark.createDataFrame([("a",)], "batch string")).first().append_only
    import json
    rec = {"version": 1, "rows_total": 5, "coefficients": {"distance_km": 0.5}, "feature_columns": ["distance_km"]}
    df = registry.records_frame(spark, [rec])
    js = registry.sidecar_json(df).first().sidecar
    keys = list(json.loads(js).keys())
    assert keys == [k for k in registry.SIDECAR_KEYS if k in keys]          # pinned order
    assert json.loads(js)["coefficients"] == {"distance_km": 0.5}


def test_export_roundtrip_and_pulse_readers(spark, tmp_dir):
    """Exported batches read back by the metric readers give the same numbers; a bad file drops its batch."""
    from datetime import datetime
    from ordersight.operators import metrics
    from ordersight.options import WindowOptions
    from ordersight.sources import exported
    W = WindowOptions(60, 1)
    f = spark.createDataFrame(
        [(f"o{i}", datetime(2024, 5, 1, 12, i % 60, 0), 12, 1, 3.0, 15, 25.5, i % 2, f"20240501T12{i % 3:02d}00Z_0001", i)
         for i in range(90)],
        "order_id string, timestamp timestamp, hour int, is_peak int, distance_km double, prep_minutes int, "
        "order_value double, was_late int, batch string, pos long")
    from ordersight.operators.scoring import score_fixed, GOLDEN_COEFFICIENTS, GOLDEN_INTERCEPT
    p = score_fixed(f, GOLDEN_COEFFICIENTS, GOLDEN_INTERCEPT, "model_v0001")
    export.export_features(f, f"{tmp_dir}/features")
    export.export_predictions(p, f"{tmp_dir}/predictions")
    back_f, gf = exported.READERS["features"](spark, f"{tmp_dir}/features")
    back_p, gp = exported.READERS["predictions"](spark, f"{tmp_dir}/predictions")
    assert gf.where("usable").count() == 3 and gp.where("usable").count() == 3
    a = metrics.volume_over_time(back_f, W).orderBy("slot").collect()
    b = metrics.volume_over_time(f, W).orderBy("slot").collect()
    assert [r.orders for r in a] == [r.orders for r in b]
    # damage one prediction file: its batch is skipped as a whole
    import glob
    victim = sorted(glob.glob(f"{tmp_dir}/predictions/batch=20240501T120100Z_0001/*.csv"))[0]
    with open(victim) as fh:
        text = fh.read()
    with open(victim, "w") as fh:
        fh.write(text.replace(",0,model", ",7,model", 1))
    crc = os.path.join(os.path.dirname(victim), "." + os.path.basename(victim) + ".crc")
    if os.path.exists(crc):
        os.remove(crc)                      # the local checksum of the edited test file
    back_p, gp = exported.read_predictions(spark, f"{tmp_dir}/predictions")
    bad = {r.batch: r.skip_reason for r in gp.where("NOT usable").collect()}
    assert list(bad) == ["20240501T120100Z_0001"] and bad["20240501T120100Z_0001"].startswith("non-numeric prediction")
    assert back_p.select("batch").distinct().count() == 2


def test_scoring_scan_skips_batch_with_non_numeric_feature(spark, tmp_dir):
    from ordersight.sources import exported
    import os
    for b, rows in {"k1": ["a,3.0,15,1", "b,4.5,20,2"], "k2": ["c,abc,15,1", "d,4.5,20,2"]}.items():
        os.makedirs(f"{tmp_dir}/batch={b}")
        with open(f"{tmp_dir}/batch={b}/part-0.csv", "w") as fh:
            fh.write("order_id,distance_km,prep_minutes,pos\n" + "\n".join(rows) + "\n")
    rows, guard = exported.read_for_scoring(spark, tmp_dir, ["distance_km", "prep_minutes"])
    assert sorted(r.order_id for r in rows.collect()) == ["a", "b"]
    assert {r.batch: (r.usable, r.skip_reason) for r in guard.collect()} == {"k1": (True, None), "k2": (False, "non-numeric distance_km on line 2")}
    rows, guard = exported.read_for_scoring(spark, tmp_dir, ["weather"])
    assert rows.count() == 0 and {r.skip_reason for r in guard.collect()} == {"missing column weather"}


def _write(path, data):
    with open(path, "wb") as fh:
        fh.write(data if isinstance(data, bytes) else data.encode())


def test_columns_are_found_by_name_in_each_file(spark, tmp_dir):
    """SRC-07..11, UDF-03: files of one folder may order their columns differently; one without a column is skipped alone."""
    from ordersight.sources import exported
    key = lambda i: f"20240501T1200{i:02d}Z_{i:04d}"
    files = [
        'order_id,timestamp,distance_km,prep_minutes,was_late\r\na,2024-05-01T12:00:01Z,3.0,15,1\r\nb,2024-05-01T12:00:02Z, 4.5 ,20,0\r\n',
        'was_late,extra,prep_minutes,"distance_km",timestamp,order_id\n0,"x, y",7,1.5,2024-05-01T12:00:03Z,"c ""q""\nd"\n,,,,,\n',
        'was_late,prep_minutes,distance_km,timestamp,order_id\n1,9,2.5,2024-05-01T12:00:04Z,e\n',
        'was_late,distance_km,timestamp,order_id\n1,9,2024-05-01T12:00:05Z,f\n',
        b'order_id,timestamp,distance_km,prep_minutes,was_late\n\xe9,2024-05-01T12:00:06Z,3.0,15,1\n',
        'order_id,timestamp,distance_km,prep_minutes,was_late\ng,2024-05-01T12:00:07Z,3.0,15,1\nh,2024-05-01T12:00:08Z,3.0,15\n',
    ]
    for i, data in enumerate(files):
        _write(f"{tmp_dir}/features_{key(i)}.csv", data)
    rows, guard = exported.read_for_training(spark, tmp_dir)
    assert sorted((r.distance_km, r.prep_minutes, r.was_late) for r in rows.collect()) == [(2.5, 9.0, 1), (3.0, 15.0, 1), (4.5, 20.0, 0)]
    want = {key(0): None, key(1): "unusable value on line 3", key(2): None, key(3): "missing columns", key(4): "not UTF-8 text",
            key(5): "unusable value on line 3"}
    assert {r.batch: r.skip_reason for r in guard.collect()} == want
    rows, guard = exported.read_for_scoring(spark, tmp_dir, ["prep_minutes", "distance_km"])
    assert {r.batch: r.skip_reason for r in guard.where("NOT usable").collect()} == {
        key(1): "non-numeric prep_minutes on line 3", key(3): "missing column prep_minutes", key(4): "not UTF-8 text"}
    got = {r.order_id: (r.prep_minutes, r.distance_km) for r in rows.collect()}
    assert got == {"a": (15.0, 3.0), "b": (20.0, 4.5), "e": (9.0, 2.5), "g": (15.0, 3.0), "h": (15.0, 3.0)}


def test_fields_match_the_csv_module(spark):
    import csv
    import random
    from pyspark.sql import functions as F
    from ordersight.sources import raw_files
    rnd = random.Random(2)
    lines = ["".join(rnd.choice(['"', '"', ",", ",", "a", " ", "bc", '""']) for _ in range(rnd.randint(0, 12))) for _ in range(400)]
    lines = [x for x in lines if "\n" not in x and not _ends_open(x)]
    got = [r.f for r in spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, x string").select(
        "i", raw_files.csv_fields(F.col("x")).alias("f")).orderBy("i").collect()]
    assert [g if x else [] for g, x in zip(got, lines)] == [next(csv.reader([x]), []) for x in lines]


def _ends_open(line):
    state = "start"
    for ch in line:
        if state == "quoted":
            state = "closed" if ch == '"' else "quoted"
        elif ch == '"' and state in ("start", "closed"):
            state = "quoted"
        else:
            state = "start" if ch == "," else "plain"
    return state == "quoted"
