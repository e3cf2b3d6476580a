"""Every plan with an oracle matches DuckDB on the smoke tables, and every
plan without one runs."""

import pytest

import __spark_entry__ as E
from tests.conftest import SMOKE
from tests.oracle_util import compare, duck

SQL = E.oracle_sql()
QUERIES = E.queries()
TRAINED = {n for n in QUERIES if n not in SQL and not n.startswith("op") and n != "pipeline"}


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SMOKE).toPandas()
    want = con.sql(SQL[name]).df()
    compare(got, want)


@pytest.mark.parametrize("name", sorted(TRAINED))
def test_rows_only_plans_give_rows(spark, name):
    """Queries without SQL return rows with a value in every column of some row."""
    rows = QUERIES[name](spark, SMOKE).limit(2000).toPandas()
    assert len(rows) > 0 and not rows.columns[rows.notna().sum() == 0].tolist()


def test_saved_model_predicts_as_before(spark):
    a, b = (sorted(map(tuple, QUERIES[n](spark, SMOKE).collect())) for n in ("prediction_table", "prediction_from_saved"))
    assert a == b and len(a) > 0


def test_entry(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"occupation_type", "customers", "labelled_rows", "positive_rate", "mean_growth"}
    assert df.count() > 0


def test_every_plan_has_a_doc():
    from custlens.plans import REGISTRY
    assert all(p.build.__doc__ for p in REGISTRY.values())
