"""Row-quality cascade on literal raw lines (one rule at a time, bounds, order, duplicates)."""
import pytest
from pyspark.sql import functions as F

from ordersight.operators import quality

CLEAN = "ORD-1,2024-05-01T12:30:00Z,3.2,15,25.50,1"


def annotate_lines(spark, lines, batch="20240501T120000Z_0001"):
    rows = [(batch, i + 1, ln) for i, ln in enumerate(lines)]
    raw = spark.createDataFrame(rows, "batch string, pos long, raw_line string") \
        .withColumn("batch_time", F.to_timestamp(F.lit("2024-05-01 12:00:00")))
    return quality.annotate(raw)


def reasons(spark, lines):
    return [r.reason for r in annotate_lines(spark, lines).orderBy("pos").collect()]


@pytest.mark.parametrize("line,reason", [
    (CLEAN, None),
    ("ORD-1,2024-05-01T12:30:00Z,3.2,15,25.50", "wrong_field_count"),
    ("ORD-1,2024-05-01T12:30:00Z,3.2,15,25.50,1,extra", "wrong_field_count"),
    ("ORD-1,2024-05-01T12:30:00Z,3.2,15,25.50,1,", "wrong_field_count"),
    ("ORD-1", "wrong_field_count"),
    ("   ", "wrong_field_count"),
    ("ORD-1,2024-05-01T12:30:00Z,3.2,15,,1", "blank"),
    (",2024-05-01T12:30:00Z,3.2,15,25.50,1", "blank"),
    ("ORD-1,2024-05-01T12:30:00Z,3.2,15,25.50,", "blank"),
    ("ORD-1,2024-05-01 12:30:00Z,3.2,15,25.50,1", "bad_timestamp"),
    ("ORD-1,2024-13-01T12:30:00Z,3.2,15,25.50,1", "bad_timestamp"),
    ("ORD-1,2024-02-30T12:30:00Z,3.2,15,25.50,1", "bad_timestamp"),
    ("ORD-1,2024-05-01T24:00:00Z,3.2,15,25.50,1", "bad_timestamp"),
    ("ORD-1,yesterday,3.2,15,25.50,1", "bad_timestamp"),
    ("ORD-1,2024-05-01T12:30:00Z,abc,15,25.50,1", "not_a_number"),
    ("ORD-1,2024-05-01T12:30:00Z,nan,15,25.50,1", "not_a_number"),
    ("ORD-1,2024-05-01T12:30:00Z,inf,15,25.50,1", "not_a_number"),
    ("ORD-1,2024-05-01T12:30:00Z,1e999,15,25.50,1", "not_a_number"),
    ("ORD-1,2024-05-01T12:30:00Z,6.4d,15,25.50,1", "not_a_number"),
    ("ORD-1,2024-05-01T12:30:00Z,3.2,n/a,25.50,1", "not_a_number"),
    ("ORD-1,2024-05-01T12:30:00Z,3.2,12.5,25.50,1", "not_a_number"),
    ('ORD-1,2024-05-01T12:30:00Z,3.2,15,"1,234.00",1', "not_a_number"),
    ("ORD-1,2024-05-01T12:30:00Z,-1.0,15,25.50,1", "out_of_range"),
    ("ORD-1,2024-05-01T12:30:00Z,0,15,25.50,1", "out_of_range"),
    ("ORD-1,2024-05-01T12:30:00Z,50.1,15,25.50,1", "out_of_range"),
    ("ORD-1,2024-05-01T12:30:00Z,999.0,15,25.50,1", "out_of_range"),
    ("ORD-1,2024-05-01T12:30:00Z,3.2,0,25.50,1", "out_of_range"),
    ("ORD-1,2024-05-01T12:30:00Z,3.2,121,25.50,1", "out_of_range"),
    ("ORD-1,2024-05-01T12:30:00Z,3.2,15,0,1", "out_of_range"),
    ("ORD-1,2024-05-01T12:30:00Z,3.2,15,1000.01,1", "out_of_range"),
    ("ORD-1,2024-05-01T12:30:00Z,3.2,15,25.50,yes", "bad_label"),
    ("ORD-1,2024-05-01T12:30:00Z,3.2,15,25.50,2", "bad_label"),
    ("ORD-1,2024-05-01T12:30:00Z,3.2,15,25.50,true", "bad_label"),
])
def test_each_reason(spark, line, reason):
    assert reasons(spark, [line]) == [reason]


def test_inclusive_upper_bounds_and_whole_float(spark):
    lines = ["A,2024-05-01T12:30:00Z,50,120,1000,0", "B,2024-05-01T12:30:00Z,50.0,18.0,1000.00,1"]
    assert reasons(spark, lines) == [None, None]
    f = quality.features(annotate_lines(spark, lines)).orderBy("pos").collect()
    assert f[1].prep_minutes == 18 and f[1].distance_km == 50.0


def test_first_failing_rule_wins(spark):
    # blank value and bad label: blank is checked first; bad timestamp and out-of-range: timestamp first
    assert reasons(spark, ["A,2024-05-01T12:30:00Z,3,15,,yes"]) == ["blank"]
    assert reasons(spark, ["A,bad,999,15,10,yes"]) == ["bad_timestamp"]


def test_duplicates_first_claims_even_when_rejected(spark):
    lines = ["ORD-1,bad,3.2,15,25.50,1",               # rejected (timestamp) but claims ORD-1
             CLEAN,                                     # duplicate of ORD-1
             " ORD-2 ,2024-05-01T12:30:00Z,3.2,15,25.50,1",
             "ORD-2,2024-05-01T12:30:00Z,3.2,15,25.50,1",  # same id after trim
             ",2024-05-01T12:30:00Z,3.2,15,25.50,1",   # blank ids claim nothing
             ",2024-05-01T12:30:00Z,3.2,15,25.50,1",
             "ORD-3,2024-05-01T12:30:00Z,3.2,15,25.50",  # wrong count still claims its id
             "ORD-3,2024-05-01T12:30:00Z,3.2,15,25.50,1"]
    assert reasons(spark, lines) == ["bad_timestamp", "duplicate_id", None, "duplicate_id",
                                     "blank", "blank", "wrong_field_count", "duplicate_id"]


def test_duplicates_are_per_batch(spark):
    rows = [("b1", 1, CLEAN), ("b2", 1, CLEAN)]
    raw = spark.createDataFrame(rows, "batch string, pos long, raw_line string") \
        .withColumn("batch_time", F.current_timestamp())
    assert [r.reason for r in quality.annotate(raw).collect()] == [None, None]


def test_hours_and_peak_edges(spark):
    lines = [f"O{h},2024-05-01T{h:02d}:00:00Z,3,15,10,1" for h in range(24)]
    f = quality.features(annotate_lines(spark, lines)).orderBy("pos").collect()
    assert [r.hour for r in f] == list(range(24))
    assert [h for h, r in zip(range(24), f) if r.is_peak] == [11, 12, 13, 17, 18, 19, 20]


def test_rejects_keep_raw_text(spark):
    lines = [" ORD-9 ,2024-05-01T12:30:00Z,3.2,15,25.50,1,extra", "ORD-8,2024-05-01T12:30:00Z,3.2,15"]
    r = quality.rejects(annotate_lines(spark, lines)).orderBy("pos").collect()
    assert r[0].raw_line == lines[0] and r[0].order_id == " ORD-9 " and r[0].was_late == "1"
    assert r[1].order_value == "" and r[1].was_late == "" and r[1].raw_line == lines[1]


def test_blank_lines_skipped_and_split_adds_up(spark):
    lines = [CLEAN, "", "ORD-2,2024-05-01T12:30:00Z,3.2,15,25.50,x"]
    a = annotate_lines(spark, lines)
    assert a.count() == 2
    s = quality.batch_stats(a).collect()[0]
    assert (s.rows_in, s.kept, s.rejected, s.bad_label) == (2, 1, 1, 1)
    assert s.reasons_text == "bad_label 1"


def test_hot_id_and_many_blanks_against_python(spark):
    """A third of one batch shares an id, another third is blank: first-occurrence semantics still hold."""
    import random
    rng = random.Random(9)
    lines, expect, seen = [], [], set()
    for i in range(1500):
        r = rng.random()
        oid = "HOT" if r < 0.33 else ("" if r < 0.66 else f"ID{rng.randint(0, 300)}")
        lines.append(f"{oid},2024-05-01T12:30:00Z,3.2,15,25.50,1")
        if oid and oid in seen:
            expect.append("duplicate_id")
        elif not oid:
            expect.append("blank")
        else:
            expect.append(None)
        if oid:
            seen.add(oid)
    assert reasons(spark, lines) == expect


def test_quoted_and_odd_first_fields_claim_like_the_parser(spark):
    lines = ['"ORD,1",2024-05-01T12:30:00Z,3.2,15,25.50,1',
             '"ORD,1",2024-05-01T12:30:00Z,3.2,15,25.50,1',          # same quoted id: duplicate
             'ORD,2024-05-01T12:30:00Z,3.2,15,25.50,1',              # "ORD" differs from "ORD,1"
             ' "Q" ,2024-05-01T12:30:00Z,3.2,15,25.50,1',            # not a quoted field (space first)
             ' "Q" ,2024-05-01T12:30:00Z,3.2,15,25.50,1',
             '"A""B",2024-05-01T12:30:00Z,3.2,15,25.50,1',           # escaped quote inside
             '"A""B",2024-05-01T12:30:00Z,3.2,15,25.50,1',
             'solo',
             'solo']
    assert reasons(spark, lines) == [None, "duplicate_id", None, None, "duplicate_id", None, "duplicate_id",
                                     "wrong_field_count", "duplicate_id"]


def test_quoted_fields_equal_the_csv_module(spark):
    import csv
    from ordersight.operators import quality
    lines = ['"A""1",x,1,2,3,0', '"A\\",x,1,2,3,0', 'a,"b,c",1,2,3,0', '"",x,1,2,3,0', 'a,"say ""hi""",1,2,3,1']
    df = spark.createDataFrame([(i, ln) for i, ln in enumerate(lines)], "pos long, raw_line string")
    for r in quality.parse_raw(df).collect():
        want = next(csv.reader([lines[r.pos]]))
        assert [v or "" for v in list(r)[2:8]] == want and not r._wrong_count
    firsts = df.select("pos", quality.first_csv_field(df.raw_line).alias("f")).collect()
    assert [(r.f or "") for r in sorted(firsts)] == [next(csv.reader([ln]))[0] for ln in lines]
