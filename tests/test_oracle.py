"""Every query against its SQL on DuckDB."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    got_columns, got = normalized(df.columns, [tuple(r) for r in df.collect()])
    assert got, name
    if name not in ORACLE:
        return
    result = db.execute(ORACLE[name])
    want_columns, want = normalized([c[0] for c in result.description], result.fetchall())
    assert got_columns == want_columns
    assert len(got) == len(want)
    different = [(g, w) for g, w in zip(got, want) if g != w]
    assert not different, different[:3]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
