"""Comparison of Spark rows with DuckDB rows."""

from __future__ import annotations

import math
import os

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return str(v)


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in data), key=repr)


def same(df, con, sql: str) -> None:
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    mine, theirs = rows(df.columns, df.collect()), rows(names, cur.fetchall())
    assert len(mine) == len(theirs)
    assert mine == theirs
