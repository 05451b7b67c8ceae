"""Compare a Spark result with a DuckDB result, row by row and order-insensitive."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return value


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    rows = df.select(*[f"`{n}`" for n in names]).collect()
    return names, Counter(tuple(_cell(v) for v in r) for r in rows)


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter, list[str]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = [str(d[1]) for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = result.fetchall()
    return (
        [names[i] for i in order],
        Counter(tuple(_cell(r[i]) for i in order) for r in rows),
        [types[i] for i in order],
    )
