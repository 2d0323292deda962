"""Driver contract: entry smoke, registry consistency, and the SQL oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["pos", "missing", "mean_diff"]
    assert df.count() == 9


def test_registry_consistent():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 80


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 5)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "float": "FLOAT"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle(spark, duck, sf_small, name):
    df = E.queries()[name](spark, sf_small)
    sql = E.oracle_sql()[name]
    types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {sql}").fetchall()}
    for f in df.schema.fields:
        assert SPARK_TO_DUCK.get(f.dataType.simpleString()) == types[f.name], f.name
    cur = duck.execute(sql)
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(dcols, cur.fetchall())
