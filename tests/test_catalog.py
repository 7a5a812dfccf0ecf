"""Every catalogue query against its DuckDB oracle on the smallest driver tables (sf0.001)."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as se
from ordersight.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(se.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = se.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(se.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert canon(df.columns, rows) == canon(dcols, res.fetchall())


def test_every_query_runs_and_entry(spark):
    assert se.entry(spark).count() >= 0
    for name in sorted(set(se.queries()) - set(se.oracle_sql())):
        assert se.queries()[name](spark, SF).count() >= 1, name


def test_fit_and_score_scores_every_kept_order_once(spark):
    feats = se.queries()["features"](spark, SF)
    scored = se.queries()["fit_and_score"](spark, SF)
    assert scored.count() == feats.count()
    assert scored.join(feats.select("order_id", "batch", "pos"), ["order_id", "batch", "pos"], "left_anti").count() == 0
    bad = scored.where("late_probability < 0 OR late_probability > 1 OR predicted_late NOT IN (0, 1)").count()
    assert bad == 0
