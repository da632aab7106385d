"""Every registered query runs on whole tables and agrees with its SQL in DuckDB."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
QUERIES, ORACLE = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    rows = ordered(tuple(plain(r[c]) for c in columns) for r in df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan
    if name in ORACLE:
        cursor = duck.execute(ORACLE[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == columns
        place = [names.index(c) for c in columns]
        assert rows == ordered(tuple(plain(r[i]) for i in place) for r in cursor.fetchall())


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
