"""Compare a query with its oracle the way the driver does: columns by name, rows as a multiset."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, int):
        return f"{float(value):.9g}" if abs(value) < 2**53 else str(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if type(value).__name__ == "Decimal":
        return f"{float(value):.9g}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(cell(v) for v in value) + "]"
    return str(value)


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql: str):
    """None if equal, else a short description of the difference."""
    left_cols, left = multiset(spark_df.columns, [tuple(x) for x in spark_df.collect()])
    cursor = con.execute(sql)
    right_cols, right = multiset([d[0] for d in cursor.description], cursor.fetchall())
    if left_cols != right_cols:
        return f"columns {left_cols} != {right_cols}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        only_left = sorted(set(left) - set(right))[:3]
        only_right = sorted(set(right) - set(left))[:3]
        return f"{len(bad)} rows differ, spark {only_left} oracle {only_right}"
    return None if left else "no rows"
