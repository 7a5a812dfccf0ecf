"""The feed adapter reproduces the defect mix stated for the driver tables (sf0.01)."""
import os

import pytest
from pyspark.sql import functions as F

from ordersight.plans.context import FeedContext

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_reason_counts_and_newest_week(spark):
    ctx = FeedContext(spark, SF)
    ann = ctx.annotated()
    counts = {r.reason: r["count"] for r in ann.groupBy("reason").count().collect()}
    assert counts == {None: 7694, "out_of_range": 489, "not_a_number": 399, "bad_timestamp": 325, "blank": 314,
                      "duplicate_id": 310, "wrong_field_count": 302, "bad_label": 167}
    st = ctx.stage()
    k = st["features"].agg(F.max("timestamp")).first()[0]
    end = k.replace(minute=0, second=0, microsecond=0)
    from datetime import timedelta
    start = end + timedelta(hours=1) - timedelta(days=7)
    kept = st["features"].where(F.col("batch_time") >= F.lit(start)).count()
    rejected = st["rejects"].where(F.col("batch_time") >= F.lit(start)).count()
    assert (kept, rejected) == (1793, 538)


def test_raw_lines_have_declared_field_counts(spark):
    raw = FeedContext(spark, SF).raw()
    fields = FeedContext(spark, SF).fields().select("pos", "n_fields")
    j = raw.join(fields, "pos")
    # a field count is the number of top-level commas + 1 (the feed never quotes)
    bad = j.where(F.size(F.split("raw_line", ",")) != F.col("n_fields")).count()
    assert bad == 0
