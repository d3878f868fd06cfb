"""Compare a query's rows with those of its SQL, regardless of order."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return float(f"{value:.9g}")
    if hasattr(value, "as_tuple"):
        return float(f"{float(value):.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def connect(folder: str):
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def of_sql(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return bag(result.fetchall(), columns)


def of_frame(df):
    return bag(df.collect(), df.columns)
