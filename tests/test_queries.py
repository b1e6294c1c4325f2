"""Every query of the library against its SQL in DuckDB, on the same files."""

import decimal
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from attesta.plans import queries, record_queries, stage_queries  # noqa: F401

NAMES = sorted(queries.QUERIES)


def plain(v):
    v = float(v) if isinstance(v, decimal.Decimal) else v
    return round(v, 9) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_rows_are_those_of_the_sql(spark, sf_dir, con, name):
    df = queries.QUERIES[name](spark, sf_dir)
    rows = df.collect()
    assert rows
    if name in queries.ORACLES:
        got = con.execute(queries.ORACLES[name])
        columns = [d[0] for d in got.description]
        assert sorted(columns) == sorted(df.columns)
        order = sorted(columns)
        want = sorted(([plain(r[columns.index(c)]) for c in order] for r in got.fetchall()), key=str)
        assert sorted(([plain(r[c]) for c in order] for r in rows), key=str) == want


def test_entry_has_all_queries(spark):
    assert set(NAMES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_pushdown_and_pruning(spark, sf_dir):
    plan = queries.QUERIES["url_domain"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan and "Exchange" not in plan
