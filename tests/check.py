"""Compare the rows of a Spark query with those of its SQL in DuckDB."""

import math
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9e}")
    return value


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in records), key=repr)


def compare(df, connection, sql):
    """None if both give the same columns, types of value and rows, else what differs."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    expected, got = rows(names, result.fetchall()), rows(df.columns, df.collect())
    if len(expected) != len(got):
        return f"{len(got)} rows, SQL gives {len(expected)}"
    for mine, theirs in zip(got, expected):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"row {mine}, SQL gives {theirs}"
    return None
