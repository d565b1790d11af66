"""Every registered query against DuckDB on whole tables."""

from __future__ import annotations

import pytest

from chatlens.catalog.oracle import ORACLE_SQL
from chatlens.catalog.queries import QUERIES
from tests.compare import differences, duck, run_sql


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf, name):
    assert differences(QUERIES[name](spark, sf).toArrow(), run_sql(con, ORACLE_SQL[name])) == []
