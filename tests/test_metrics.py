"""Windowed metrics on hand-made frames."""
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ordersight.operators import metrics, findings
from ordersight.options import WindowOptions

W = WindowOptions(window_minutes=60, bucket_minutes=1)


def feats(spark, rows):
    return spark.createDataFrame(rows, "order_id string, timestamp timestamp, batch string, batch_time timestamp, pos long")


def t(s):
    return datetime.fromisoformat(s)


def test_window_is_anchored_and_half_open(spark):
    f = feats(spark, [("a", t("2024-05-01 12:00:30"), "b", t("2024-05-01 12:00:00"), 1),
                      ("b", t("2024-05-01 11:00:59"), "b", t("2024-05-01 11:00:00"), 2),
                      ("c", t("2024-05-01 11:01:00"), "b", t("2024-05-01 11:00:00"), 3)])
    b = metrics.window_bounds(f, W).collect()[0]
    assert b.window_end == t("2024-05-01 12:01:00") and b.window_start == t("2024-05-01 11:01:00")
    assert metrics.sample_volume(f, W).collect()[0].orders == 2       # 11:00:59 is outside


def test_volume_zero_fill_60_buckets(spark):
    f = feats(spark, [("a", t("2024-05-01 12:00:30"), "b", t("2024-05-01 12:00:00"), 1),
                      ("b", t("2024-05-01 11:30:10"), "b", t("2024-05-01 11:00:00"), 2)])
    v = metrics.volume_over_time(f, W).orderBy("slot").collect()
    assert len(v) == 60 and sum(r.orders for r in v) == 2
    assert v[-1].orders == 1 and v[29].orders == 1 and v[0].orders == 0


def test_flag_rate_gaps_and_orphans(spark):
    f = feats(spark, [("a", t("2024-05-01 12:00:30"), "b1", t("2024-05-01 12:00:00"), 1),
                      ("b", t("2024-05-01 12:00:40"), "b1", t("2024-05-01 12:00:00"), 2)])
    p = spark.createDataFrame([("a", 0.7, 1, "model_v0001", "b1"), ("b", 0.2, 0, "model_v0001", "b1"),
                               ("a", 0.9, 1, "model_v0001", "b2")],       # b2/a: no feature row -> orphan
                              "order_id string, late_probability double, predicted_late int, checkpoint_id string, batch string")
    r = metrics.late_flag_rate_over_time(p, f, W).orderBy("slot").collect()
    assert r[-1].flagged_late_pct == 50.0 and r[0].flagged_late_pct is None
    assert metrics.orphan_predictions(p, f).count() == 1


def test_score_summary_known_frame(spark):
    p = spark.createDataFrame([(f"o{i}", v, int(v >= 0.5), c) for i, (v, c) in enumerate(
        [(0.1, "model_v0002"), (0.2, "model_v0002"), (0.6, "model_v0010"), (0.9, "model_v0010")])],
        "order_id string, late_probability double, predicted_late int, checkpoint_id string")
    s = metrics.score_summary(p).collect()[0]
    assert s.n == 4 and s.flag_rate == 50.0 and s.mean_probability == pytest.approx(0.45)
    assert s.p50 == pytest.approx(0.4) and s.p10 == pytest.approx(0.13)
    assert s.current_checkpoint == "model_v0010"      # numeric version, not text order


def test_empty_summary_is_nulls(spark):
    p = spark.createDataFrame([], "order_id string, late_probability double, predicted_late int, checkpoint_id string")
    s = metrics.score_summary(p).collect()[0]
    assert s.n == 0 and s.flag_rate is None and s.p50 is None


def test_drop_rate_uses_batch_time_and_failures_rank(spark):
    f = feats(spark, [("a", t("2024-05-01 12:00:30"), "b", t("2024-05-01 12:00:00"), 1)])
    rej = spark.createDataFrame([(r, "b", t("2024-05-01 12:00:00")) for r in
                                 ["blank", "blank", "out_of_range", "mystery_code"]],
                                "reason string, batch string, batch_time timestamp")
    d = metrics.drop_rate(f, rej, W).collect()[0]
    assert d.drop_rate == pytest.approx(80.0)
    fc = metrics.failure_counts(rej, f, W).orderBy("rnk").collect()
    assert [(r.label, r.rows_dropped) for r in fc] == [("Missing value", 2), ("Value out of range", 1),
                                                       ("mystery_code", 1)] or \
        [(r.label, r.rows_dropped) for r in fc] == [("Missing value", 2), ("Value out of range", 1), ("mystery_code", 1)]
    top = findings.failures_finding(metrics.failure_counts(rej, f, W), 60).collect()[0]
    assert top.top_label == "Missing value" and top.text == "Missing values cause most dropped rows (50%)"


def series(spark, values, name="orders"):
    dtype = "long" if name == "orders" else "double"
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"slot long, {name} {dtype}")


def test_volume_finding_statuses(spark):
    n = 60
    steady = [0] + [10] * (n - 1)
    r = findings.volume_finding(series(spark, steady), n, 1).collect()[0]
    assert r.status == "steady" and r.text == "Orders are steady at ~10 per minute"
    rose = [0] + [10] * 40 + [20] * (n - 41)
    assert findings.volume_finding(series(spark, rose), n, 1).collect()[0].status == "rose"
    stalled = [10] * (n - 3) + [0, 0, 0]
    s = findings.volume_finding(series(spark, stalled), n, 1).collect()[0]
    assert s.status == "stalled" and "3 minutes" in s.text
    assert findings.volume_finding(series(spark, [0] * n), n, 1).collect()[0].status == "none"
    started = [0] * (n - 2) + [5, 5]
    assert findings.volume_finding(series(spark, started), n, 1).collect()[0].status == "just_started"
    # idle time from the wall clock stalls an otherwise steady series
    assert findings.volume_finding(series(spark, steady), n, 1, idle_minutes=2.0).collect()[0].status == "stalled"


def test_flag_finding_edges(spark):
    n = 60
    vals = [40.0] * 50 + [44.0] * 10
    assert findings.flag_finding(series(spark, vals, "pct"), n, "pct").collect()[0].status == "steady"
    vals = [40.0] * 50 + [45.0] * 10
    r = findings.flag_finding(series(spark, vals, "pct"), n, "pct").collect()[0]
    assert r.status == "more" and r.text == "The model is flagging more orders late (45% vs 40%)"
    vals = [None] * 50 + [30.0] * 10
    assert findings.flag_finding(series(spark, vals, "pct"), n, "pct").collect()[0].status == "steady"
    assert findings.flag_finding(series(spark, [None] * n, "pct"), n, "pct").collect()[0].status == "none"


def test_clock_and_gap_segments(spark):
    df = spark.createDataFrame([(t("2024-05-01 12:10:00"), t("2024-05-01 12:04:59")),
                                (t("2024-05-01 12:05:00"), t("2024-05-01 12:00:00"))], "newest timestamp, now timestamp")
    got = [r.s for r in df.select(findings.clock_finding(F.col("newest"), F.col("now")).alias("s")).collect()]
    assert got == ["clock_ahead", "ok"]                # strictly more than 5 minutes ahead
    g = findings.gap_segments(series(spark, [1.0, None, 2.0, 3.0, None, None, 4.0], "pct"), "pct").orderBy("slot").collect()
    assert [r.segment for r in g] == [0, 1, 1, 3]


@pytest.mark.parametrize("minutes,has_prev", [(61, False), (90, False), (119, False), (120, True), (121, True)])
def test_deltas_only_with_fully_covered_previous_window(spark, minutes, has_prev):
    """A perfectly steady feed (one order per minute, starting mid-minute): the previous window counts
    only when the data reaches back into its first bucket."""
    from datetime import timedelta
    t0 = t("2024-05-01 10:00:30")
    rows = [(f"o{i}", t0 + timedelta(minutes=i), "b", t0.replace(second=0) + timedelta(minutes=i), i)
            for i in range(minutes)]
    f = feats(spark, rows)
    rej = spark.createDataFrame([], "reason string, batch string, batch_time timestamp")
    p = spark.createDataFrame([(f"o{i}", 0.7, 1, "model_v0001", "b") for i in range(minutes)],
                              "order_id string, late_probability double, predicted_late int, checkpoint_id string, batch string")
    k = metrics.kpi_deltas(metrics.kpi_numbers(f, rej, p, W)).first()
    assert k.has_previous == has_prev and k.orders == 60
    if has_prev:
        assert k.orders_delta == 0 and k.orders_delta_text == "+0" and k.flag_delta_pp == 0.0
    else:
        assert k.orders_delta is None and k.drop_delta_pp is None


def test_unique_key_lookup_and_literal_end_match_the_generic_path(spark):
    from ordersight.plans.context import FeedContext
    ctx = FeedContext(spark, "/root/testdata/sf0.001")
    st = ctx.stage()
    f, p, r = st["features"], st["predictions"], st["rejects"]
    # the cascade leaves one kept row per (batch, order_id): the premise of unique_keys
    assert f.groupBy("batch", "order_id").count().where("count > 1").count() == 0
    generic = metrics.late_flag_rate_over_time(p, f, ctx.window).collect()
    fast = metrics.late_flag_rate_over_time(p, f, ctx.window, end=ctx.window_end(), unique_keys=True).collect()
    assert sorted(map(tuple, generic)) == sorted(map(tuple, fast))
    k1 = metrics.kpi_numbers(f, r, p, ctx.window).collect()
    k2 = metrics.kpi_numbers(f, r, p, ctx.window, end=ctx.window_end(), unique_keys=True).collect()
    assert [tuple(x) for x in k1] == [tuple(x) for x in k2]


def test_pulse_view_and_keyed_flag_rate_fast_paths_match(spark):
    from ordersight.plans.context import FeedContext
    from ordersight.plans.view import pulse_view
    ctx = FeedContext(spark, "/root/testdata/sf0.001")
    st = ctx.stage()
    f, p, r = st["features"], st["predictions"], st["rejects"]
    now = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    slow = pulse_view(f, r, p, ctx.window, now)
    fast = pulse_view(f, r, p, ctx.window, now, end=ctx.window_end(), unique_keys=True)
    for part in ("summary", "kpis", "volume", "flag_rate", "failures", "flag_finding"):
        a, b = getattr(slow, part).collect(), getattr(fast, part).collect()
        assert sorted(map(tuple, a)) == sorted(map(tuple, b)), part
    k1 = metrics.late_flag_rate_over_time_by(p, f, ctx.window, ["is_peak"]).collect()
    k2 = metrics.late_flag_rate_over_time_by(p, f, ctx.window, ["is_peak"], end=ctx.window_end(), unique_keys=True).collect()
    assert sorted(map(tuple, k1)) == sorted(map(tuple, k2))


def test_window_anchor_is_observed_during_the_stage_write(spark):
    from ordersight.plans import context
    ctx = context.FeedContext(spark, "/root/testdata/sf0.001")
    f = ctx.stage()["features"]
    observed = context._NEWEST.get(ctx.stage_dir())
    assert observed is not None
    assert observed == f.agg(F.max(F.unix_seconds("timestamp"))).first()[0]
