"""Comparison of a query with its SQL in DuckDB."""

import math
from pathlib import Path

import duckdb


def views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}/*.parquet'" if p.is_dir() else f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of_spark(df):
    columns = sorted(df.columns)
    return columns, sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())


def rows_of_sql(con, sql):
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    columns = sorted(names)
    at = [names.index(c) for c in columns]
    return columns, sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())
