"""Comparing a Spark result with DuckDB's rows."""

from __future__ import annotations

import duckdb

NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return None if value != value else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


def rows(df):
    columns = sorted(df.columns)
    return columns, sorted(repr(tuple(map(plain, r))) for r in df.select(columns).collect())


def sql_rows(sql: str, sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted(repr(tuple(plain(r[i]) for i in order)) for r in result.fetchall())
