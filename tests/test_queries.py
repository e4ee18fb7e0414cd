"""Every registered query against its SQL on the test tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Training runs of many minutes; test_models covers the operators with fewer rounds.
SLOW = {"temporal_grid_search"}


@pytest.fixture(scope="module")
def duck(data_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.9g}") + 0.0
    return v


def sortable(row):
    return [(v is None, "" if v is None else str(v)) for v in row]


@pytest.mark.parametrize("name", sorted(set(ORACLE) - SLOW))
def test_matches_sql(spark, data_dir, duck, name):
    df = QUERIES[name](spark, data_dir)
    columns = sorted(df.columns)
    got = sorted(([plain(r[c]) for c in columns] for r in df.collect()), key=sortable)
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted(([plain(r[i]) for i in order] for r in cursor.fetchall()), key=sortable)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - SLOW))
def test_runs_and_keeps_its_schema(spark, data_dir, name):
    first = QUERIES[name](spark, data_dir)
    assert first.count() > 0
    assert first.columns


def test_entry(spark):
    df = entry.entry(spark)
    assert [r["bucket"] for r in df.orderBy("bucket").collect()][0] == "0"


def test_every_query_with_sql_exists():
    assert set(ORACLE) <= set(QUERIES)
