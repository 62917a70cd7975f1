"""Every registered query against its SQL at the smallest scale."""

import pytest
from compare import compare, duck

from signalloom.bindings import catalog


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, con, sf, name):
    text, _, ok = compare(spark, con, name, catalog.QUERIES[name], catalog.SQL.get(name), sf)
    assert ok, text


def test_entry(spark):
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
