"""The queries that SQL can express, against their SQL counterparts."""

import pytest
from compare import connect, difference
from conftest import MEDIUM

from incident_engine.llm.oracle import ORACLE
from incident_engine.llm.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    connection = connect(MEDIUM)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, MEDIUM), con, ORACLE[name]) is None
