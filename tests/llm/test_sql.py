"""Queries of the training-data operators that SQL can express, on whole tables."""

from __future__ import annotations

import pytest

from chatlens.llm.catalog import ORACLE_SQL, QUERIES
from tests.compare import differences, duck, run_sql


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, con, sf, name):
    assert differences(QUERIES[name](spark, sf).toArrow(), run_sql(con, ORACLE_SQL[name])) == []
