"""Compares a Spark result with its oracle in DuckDB."""

import math

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "double": "DOUBLE",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def sort_key(row):
    return tuple((v is None, f"{v:.6g}" if isinstance(v, float) else str(v)) for v in row)


def assert_same(df, con, sql):
    names = sorted(df.columns)
    found = con.execute(sql)
    have = [c[0] for c in found.description]
    assert sorted(have) == names
    types = {c[0]: str(c[1]) for c in found.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    places = [have.index(n) for n in names]
    expected = sorted((tuple(plain(r[p]) for p in places) for r in found.fetchall()), key=sort_key)
    rows = df.select(*[f"`{n}`" for n in names]).collect()
    actual = sorted((tuple(plain(v) for v in r) for r in rows), key=sort_key)
    assert len(actual) == len(expected)
    for a, b in zip(actual, expected):
        assert a == b, {n: (x, y) for n, x, y in zip(names, a, b) if x != y}
