"""The corpus queries that SQL can express against their SQL, on the smallest tables."""

import os

import duckdb
import pytest

from duskfield.llm import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got, want = queries.queries()[name](spark, DATA), con.sql(queries.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    plain = lambda v: f"{v:.6f}" if isinstance(v, float) else str(v)
    order = [want.columns.index(c) for c in columns]
    assert sorted(tuple(plain(r[c]) for c in columns) for r in got.collect()) == sorted(tuple(plain(r[k]) for k in order) for r in want.fetchall())


def test_native_queries_use_no_python(spark):
    for name in ("op2_line_dedup", "op4_quality_rules"):
        plan = queries.queries()[name](spark, DATA)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
