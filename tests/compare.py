"""Side-by-side run of a registered query and its SQL."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def cell(value):
    if isinstance(value, bool) or value is None or isinstance(value, (str, datetime)):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, int):
        return value
    return str(value)


def differences(df, con, sql: str) -> list[str]:
    """Empty when both sides give the same columns, types and rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} and {sorted(names)}"]
    kinds = {d[0]: str(d[1]) for d in result.description}
    typed = {n: (TYPES.get(t, t), kinds[n]) for n, t in df.dtypes if TYPES.get(t, t) != kinds[n]}
    if typed:
        return [f"types {typed}"]
    order = sorted(df.columns)
    ours = Counter(tuple(cell(row[c]) for c in order) for row in df.collect())
    at = [names.index(c) for c in order]
    theirs = Counter(tuple(cell(row[i]) for i in at) for row in result.fetchall())
    if ours == theirs:
        return []
    return [
        f"{sum(ours.values())} rows against {sum(theirs.values())}, columns {order}",
        *(f"only Spark: {str(row)[:600]}" for row in list((ours - theirs))[:3]),
        *(f"only SQL:   {str(row)[:600]}" for row in list((theirs - ours))[:3]),
    ]
