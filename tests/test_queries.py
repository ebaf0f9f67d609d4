"""The registered queries against their SQL, at the smallest scale."""

import os

import pytest

from __spark_entry__ import ENTRY_DIR, entry, oracle_sql, queries
from checks.compare import compare, connect
from checks.queries import QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(ENTRY_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(ENTRY_DIR)


def test_entry(spark):
    assert entry(spark).columns == ["age_group", "genre", "genre_rating_count"]
    assert entry(spark).count() == 18


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query(spark, duck, name):
    assert compare(spark, duck, ENTRY_DIR, name) == ""
