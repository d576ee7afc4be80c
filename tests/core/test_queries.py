import os

import pytest

from loomlog import queries

from ..oracle import DATA, connect, same

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")


def test_queries_equal_their_sql(spark):
    con = connect()
    wrong = [name for name, sql in queries.ORACLES.items() if not same(spark, con, queries.QUERIES[name], sql)]
    assert wrong == []


def test_queries_without_sql_have_rows(spark):
    for name in set(queries.QUERIES) - set(queries.ORACLES):
        assert queries.QUERIES[name](spark, DATA).count() > 0, name


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(queries.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
