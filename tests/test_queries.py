"""Every registered query against its SQL counterpart."""

import pytest
from compare import connect, difference
from conftest import MEDIUM

import __spark_entry__ as entry_points
from incident_engine.catalog.oracle import ORACLE
from incident_engine.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    connection = connect(MEDIUM)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, MEDIUM), con, ORACLE[name]) is None


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["grid_id", "ix", "iy", "avg_tp", "prev_n", "rk"]
    assert 0 < df.count() <= 120
