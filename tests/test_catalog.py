"""Every query with check SQL, run on the smallest tables in Spark and in DuckDB."""

import glob
import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")

from test_learning import violation  # noqa: E402

from registry import catalog  # noqa: E402
from registry.catalog import ORACLES, QUERIES  # noqa: E402
from registry.inputs import INPUT_SQL, duck_text  # noqa: E402

WITHOUT_SQL = sorted(set(QUERIES) - set(ORACLES))


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(value(r[i]) for i in order) for r in data), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, DATA)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert table(df.columns, df.collect()) == table(columns, cursor.fetchall())


def test_queries_without_sql_are_few():
    # One full fit of the replenishment model: its coefficients have no closed form.
    assert WITHOUT_SQL == ["m14_coefficient_report", "m17_fit_replenishment_model"]


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_query_without_sql_gives_rows(spark, name):
    assert not QUERIES[name](spark, DATA).isEmpty()


def test_fit_meets_the_conditions_of_the_optimum(spark):
    """The coefficients behind m14 and m17, slot by slot, from the rows they were fitted on."""
    fitted = catalog.fitted(spark, DATA)
    best = fitted.cv_model.bestModel
    point = best.getOrDefault("elasticNetParam"), best.getOrDefault("regParam")
    assert violation(best, fitted.data, fitted.spec.label, point) < 1e-3
    metrics = fitted.cv_model.avgMetrics
    maps = fitted.cv_model.getEstimatorParamMaps()
    chosen = {p.name: v for p, v in maps[metrics.index(min(metrics))].items()}
    assert point == (chosen["elasticNetParam"], chosen["regParam"]) and len(metrics) == len(maps) == 42


def test_inputs_have_no_open_words():
    assert all("[" not in duck_text(text) for text in INPUT_SQL.values())
