"""Every registered query against its SQL, value by value."""

import pytest
from checking import compare, connect

from wordloom.plans.oracles import ORACLES
from wordloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_matches_sql(spark, con, sf, name):
    problem, _ = compare(spark, con, sf, QUERIES[name], ORACLES[name])
    assert problem is None, problem


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["id", "token", "n"]
    assert set(e.oracle_sql()) <= set(e.queries())
