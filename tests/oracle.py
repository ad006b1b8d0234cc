"""Runs a registered query and its SQL side by side."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events"


def connect(folder):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(folder) / name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat() + "T00:00:00"
    return value


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


def compare(spark, folder, query, sql):
    """Empty when both sides agree, else what differs."""
    result = query(spark, str(folder))
    mine = rows(result.columns, result.collect())
    cursor = connect(folder).execute(sql)
    columns = [c[0] for c in cursor.description]
    theirs = rows(columns, cursor.fetchall())
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} against {sorted(columns)}"
    if mine != theirs:
        a, b = set(mine), set(theirs)
        only_mine = [r for r in mine if r not in b][:3]
        only_theirs = [r for r in theirs if r not in a][:3]
        return f"{len(mine)} against {len(theirs)} rows; only mine {only_mine}; only SQL {only_theirs}"
    return ""
