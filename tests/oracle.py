"""Comparison of a Spark result with DuckDB over the same Parquet files, by value and without order."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    return v


def rows(df) -> list:
    cols = sorted(df.columns)
    return sorted((tuple(plain(v) for v in r) for r in df.select(*cols).collect()), key=repr)


def sql_rows(con, statement: str) -> tuple[list[str], list]:
    got = con.execute(statement)
    names = [c[0] for c in got.description]
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(names), sorted((tuple(plain(r[k]) for k in order) for r in got.fetchall()), key=repr)
