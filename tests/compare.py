"""Order-free comparison of a Spark frame with a DuckDB result."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def duck_rows(connection, sql):
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    return names, cursor.fetchall()


def _plain(value):
    if isinstance(value, Decimal):
        return ("decimal", str(value.normalize()))
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return [_plain(item) for item in value]
    return value


def normalized(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    plain = [[_plain(row[i]) for i in order] for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def compare(frame, connection, sql):
    """Both sides as (columns, sorted rows)."""
    spark_side = normalized(frame.columns, [tuple(row) for row in frame.collect()])
    return spark_side, normalized(*duck_rows(connection, sql))
