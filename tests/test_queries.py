"""Every registered query against its SQL on the smallest tables."""

import pytest

from tests import oracle
from txlake.plans import load_queries

FOLDER = "/root/testdata/sf0.001"
QUERIES = load_queries()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    q = QUERIES[name]
    names, rows = oracle.spark_rows(q.run(spark, FOLDER))
    if q.sql is None:
        assert rows
        return
    want_names, want = oracle.sql_rows(con, q.sql)
    assert names == want_names
    assert rows == want


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
