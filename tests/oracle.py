"""Run queries and their SQL side by side and compare the rows."""

from __future__ import annotations

import math
import os

import duckdb
from pyspark.sql import DataFrame

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(x) for x in value)
    return value


def compare(df: DataFrame, sql: str, con: duckdb.DuckDBPyConnection) -> tuple[list, list]:
    """Rows on either side only, with columns sorted by name."""
    columns = sorted(df.columns)
    got = sorted((tuple(plain(x) for x in r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns, (sorted(names), columns)
    order = [names.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in order) for r in found.fetchall()), key=repr)
    if got == want:
        return [], []
    from collections import Counter

    a, b = Counter(map(repr, got)), Counter(map(repr, want))
    return list((a - b).elements()), list((b - a).elements())
