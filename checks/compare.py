"""Run a registered query and its SQL on the same data and compare the rows."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import SparkSession

from checks.duckdb_sql import SQL
from checks.spark_queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def _sortable(row):
    return [(v is not None, str(type(v)), str(v)) for v in row]


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_plain(r[i]) for i in order] for r in rows), key=_sortable)


def difference(spark: SparkSession, connection, sf_dir: str, name: str) -> str | None:
    """None if the results agree, else what differs."""
    result = QUERIES[name](spark, sf_dir)
    got = _rows(result.columns, [tuple(r) for r in result.collect()])
    if name not in SQL:
        return None if got else "no rows"
    cursor = connection.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    want = _rows(columns, cursor.fetchall())
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} want {sorted(columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows, want {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(v) for v in g] != [type(v) for v in w]:
            return f"row {g} want {w}"
    return None
