import os

import pytest

import __spark_entry__ as driver


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_entry(spark):
    """The driver contract: queries are callables, every SQL belongs to one, and the flagship has rows."""
    queries, sql = driver.queries(), driver.oracle_sql()
    assert len(queries) > 90 and set(sql) <= set(queries) and all(map(callable, queries.values()))
    assert driver.entry(spark).count() > 0
