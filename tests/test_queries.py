"""Every registered query against its SQL twin at the smallest scale."""

import pytest

from tests.oracle import compare, duck
from wardlake.plans import QUERIES


@pytest.fixture(scope="module")
def con(base):
    return duck(base)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, base, name):
    q = QUERIES[name]
    ok, note = compare(spark, con, base, q.run, q.sql)
    assert ok, note


def test_entry_file(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
