"""Scalar helpers: strict parsing, batch keys, and display text (half-even, -0.0, separators)."""
import pytest
from pyspark.sql import functions as F

from ordersight.functions import scalars as S


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


@pytest.mark.parametrize("v,text", [(115.0, "120"), (105.0, "100"), (42.5, "42"), (43.5, "44"), (99.4, "99"),
                                    (1234.0, "1,230")])
def test_about_text_half_even(spark, v, text):
    assert one(spark, S.about_text(F.lit(v))) == text


@pytest.mark.parametrize("m,text", [(2, "2 minutes"), (119, "119 minutes"), (120, "2 hours"), (2879, "47 hours"),
                                    (2880, "2 days")])
def test_duration_text(spark, m, text):
    assert one(spark, S.duration_text(F.lit(m))) == text


def test_pp_pct_and_thousands(spark):
    assert one(spark, S.pp_text(F.lit(10.0), F.lit(10.04))) == "+0.0 pp"        # -0.0 shown as 0.0
    assert one(spark, S.pp_text(F.lit(12.0), F.lit(10.0))) == "+2.0 pp"
    assert one(spark, S.pp_text(F.lit(None).cast("double"), F.lit(1.0))) is None
    assert one(spark, S.pct_text(F.lit(4.583))) == "4.6%"
    assert one(spark, S.pct_text(F.lit(None).cast("double"))) == "—"
    assert one(spark, S.thousands(F.lit(1234567))) == "1,234,567"
    assert one(spark, S.signed_thousands(F.lit(-15))) == "-15"
    assert one(spark, S.signed_thousands(F.lit(2400))) == "+2,400"


@pytest.mark.parametrize("text,ok", [("1", True), ("+1.5", True), (".5", True), ("5.", True), ("1e3", True),
                                     ("nan", False), ("inf", False), ("Infinity", False), ("1_0", False),
                                     ("6.4f", False), ("1e999", False), ("", False), ("0x10", False)])
def test_finite_number(spark, text, ok):
    assert (one(spark, S.finite_number(F.lit(text))) is not None) == ok


@pytest.mark.parametrize("text,whole", [("18", 18), ("18.0", 18), ("12.5", None), ("n/a", None), ("1e2", 100)])
def test_whole_number(spark, text, whole):
    assert one(spark, S.whole_number(F.lit(text))) == whole


def test_batch_key_and_time(spark):
    assert one(spark, S.batch_key_of(F.lit("orders_20240501T120000Z_0001.csv"))) == "20240501T120000Z_0001"
    assert one(spark, S.batch_key_of(F.lit("orders_20240501T120000Z_01.csv"))) == ""      # seq needs 4+ digits
    assert one(spark, S.batch_key_of(F.lit("orders_20240501T120000Z_0001.csv.tmp"))) == ""
    assert one(spark, S.batch_time_of(F.lit("20241301T120000Z_0001"))) is None            # impossible stamp
    assert str(one(spark, S.batch_time_of(F.lit("20240501T120000Z_0001")))) == "2024-05-01 12:00:00"
    assert one(spark, S.checkpoint_version(F.lit("model_v0012"))) == 12
    assert one(spark, S.checkpoint_version(F.lit("latest"))) == -1
    assert one(spark, S.checkpoint_name(F.lit(7))) == "model_v0007"


def test_strip_looks_at_the_ends_first_and_keeps_the_expression_for_them(spark):
    texts = ["", " ", "a", " a", "a ", "\ta\n", "a \u0085", "a\u0085", " a  ", "a b", "\x0ba\x0c\r\n", "\xa0a\xa0", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        S.strip(F.col("t")).alias("now"), F.regexp_replace(F.coalesce("t", F.lit("")), r"^\s+|\s+$", "").alias("whole"))
    assert all(r["now"] == r["whole"] for r in rows.collect())
    plan = rows.select("now")._jdf.queryExecution().optimizedPlan().toString()
    assert "btrim" in plan.lower() or "trim(" in plan.lower()


def test_spread_deals_out_one_row_group_however_many_splits_its_file_has(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from ordersight.sources.tables import spread
    pq.write_table(pa.table({"n": pa.array(range(40_000), pa.int64())}), str(tmp_path / "one.parquet"), row_group_size=1 << 20)
    keys = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = spark.read.parquet(str(tmp_path / "one.parquet"))
        assert df.rdd.getNumPartitions() >= 4  # splits enough, but only one of them holds the row group
        sizes = [r["count"] for r in spread(df, 4).groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) >= 4 and max(sizes) < 20_000 and sum(sizes) == 40_000
        assert spread(df, 1).rdd.getNumPartitions() == df.rdd.getNumPartitions()  # files enough: left alone
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_cleaning_lowers_the_bound_on_generated_methods_and_never_raises_it(spark):
    from ordersight.session import compiled_methods
    key = "spark.sql.codegen.hugeMethodLimit"
    old = spark.conf.get(key)
    try:
        for before, after in (("65535", "8000"), ("4000", "4000")):
            spark.conf.set(key, before)
            compiled_methods(spark)
            assert spark.conf.get(key) == after
    finally:
        spark.conf.set(key, old)
