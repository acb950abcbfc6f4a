"""Compare a Spark result with DuckDB on the same tables."""

from __future__ import annotations

import math
import os
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None:
        return "~"
    if isinstance(value, (float, Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else repr(number)
    return repr(value) if not isinstance(value, bool) else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def _numbers_alike(left, right):
    """Integers and floats print differently; compare them by value."""

    def norm(text):
        try:
            return repr(float(text)) if "." in text or "e" in text else repr(float(int(text)))
        except ValueError:
            return text

    return [tuple(map(norm, r)) for r in left] == [tuple(map(norm, r)) for r in right]


def compare(frame, con, oracle: str):
    """(equal, message)"""
    columns, ours = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(oracle)
    names, theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if columns != names:
        return False, f"columns {columns} != {names}"
    if len(ours) != len(theirs):
        return False, f"{len(ours)} rows != {len(theirs)}"
    if ours == theirs:
        return True, f"{len(ours)} rows"
    diff = [(a, b) for a, b in zip(ours, theirs) if a != b and not _numbers_alike([a], [b])]
    if not diff:
        return True, f"{len(ours)} rows (integer/float types differ)"
    return False, f"{len(diff)} of {len(ours)} rows differ, {columns}: {diff[:2]}"
