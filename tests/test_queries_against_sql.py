"""Every query with an oracle, against DuckDB, on the smallest sample."""

from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

from .conftest import SAMPLE

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ORACLES = oracle_sql()
# a mean of doubles that falls on a rounding tie in the smallest sample
TIES = {"d13_chart_radar"}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SAMPLE}/{table}.parquet'")
    return connection


def rows(data, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(r[i] for i in order) for r in data)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 143 and "rfm_segment" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    df = queries()[name](spark, SAMPLE)
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    got, want = rows(df.collect(), df.columns), rows(result.fetchall(), names)
    assert sorted(df.columns) == sorted(names)
    if name in TIES:
        assert sorted(got.elements(), key=keys) == close(sorted(want.elements(), key=keys))
    else:
        assert got == want


def keys(row):
    return [str(v) for v in row if not isinstance(v, float)]


def close(ordered):
    """Fractions to within a cent, everything else exact."""
    return [tuple(pytest.approx(v, abs=0.011) if isinstance(v, float) else v for v in r) for r in ordered]
