"""Every registered query against independent SQL on whole tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from medallion.queries.catalogue import QUERIES
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert differences(queries()[name](spark, sf_dir), con, oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
