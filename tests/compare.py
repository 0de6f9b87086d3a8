"""Comparing a Spark result with its SQL twin, whatever the order of rows and columns."""

from __future__ import annotations

import datetime
import decimal
import math

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(src: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{src}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    kept = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(kept, key=repr)


def differences(df, con, sql, show: int = 3) -> list[str]:
    """Empty when both sides hold the same columns and rows."""
    left_columns, left = canonical(df.columns, df.collect())
    result = con.execute(sql)
    right_columns, right = canonical([d[0] for d in result.description], result.fetchall())
    if left_columns != right_columns:
        return [f"columns {left_columns} != {right_columns}"]
    if len(left) != len(right):
        return [f"{len(left)} rows != {len(right)} rows", *(f"{a}\n    {b}" for a, b in list(zip(left, right))[:show])]
    return [f"{a}\n    {b}" for a, b in zip(left, right) if a != b or [type(x) for x in a] != [type(x) for x in b]][:show]
