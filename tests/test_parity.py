"""Every registered query against its SQL on the smallest data set."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from strata.suite import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    yield con
    con.close()


def norm(value):
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, decimal.Decimal):
        return f"{value:f}"
    if isinstance(value, datetime.datetime):
        return value.isoformat(" ")
    return str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    df = entry_point.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in columns) for r in df.collect())
    assert got, "a registered query must return rows"
    if name not in ORACLES:
        return
    duck.execute(entry_point.oracle_sql()[name])
    names = [d[0] for d in duck.description]
    assert sorted(names) == columns
    want = sorted(tuple(norm(r[names.index(c)]) for c in columns) for r in duck.fetchall())
    assert got == want


def test_entry_returns_net_pay(spark):
    df = entry_point.entry(spark)
    assert df.columns[-1] == "net_pay"
    assert df.limit(1).count() == 1
