"""Every registered query against its SQL on the same tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as spark_entry

QUERIES = spark_entry.queries()
ORACLE = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    keyed = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(keyed, key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLE[name])
    want_names, want = normal([d[0] for d in result.description], result.fetchall())
    got_names, got = normal(df.columns, [tuple(r) for r in df.collect()])
    assert got_names == want_names
    assert len(got) == len(want) > 0
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_sql(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_no_sql_without_query():
    assert set(ORACLE) <= set(QUERIES)
