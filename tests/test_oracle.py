"""Every query against its SQL over the same tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from clickweave import queries as registry
from tests.compare import connect, differences

QUERIES = registry.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry.queries()) & set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, entry.oracle_sql()[name]) == []


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns[:2] == ["area", "area_level"]
    assert rows.count() > 0
