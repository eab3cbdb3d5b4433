"""Every catalogue query with a SQL twin equals DuckDB on sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
SQL = E.oracle_sql()
NAMES = sorted(SQL)


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "window_start" in df.columns


def test_every_query_has_a_callable():
    assert set(SQL) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    cur = duck.execute(SQL[name])
    drows, dcols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(scols) == sorted(dcols)
    duck_types = {d[0]: str(d[1]).upper() for d in cur.description}
    for f in df.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        assert duck_types[f.name] == want, (f.name, f.dataType, duck_types[f.name])
    assert _canon(srows, scols) == _canon(drows, dcols)
