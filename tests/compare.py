"""Rows of a Spark query and of its SQL in a form that can be compared."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

DATA = Path("/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, list | tuple):
        return tuple(map(plain, v))
    if v is None or isinstance(v, bool | int | str):
        return v
    return float(v) if hasattr(v, "as_tuple") else str(v)


def key(row):
    return tuple((x is None, str(x)) for x in row)


def both(spark, query, sql):
    """(Spark's rows, SQL's rows), each sorted, columns by name."""
    df = query(spark, str(DATA))
    names = sorted(df.columns)
    mine = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=key)
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    cur = con.execute(sql)
    order = sorted(range(len(cur.description)), key=lambda i: cur.description[i][0])
    theirs = sorted((tuple(plain(r[i]) for i in order) for r in cur.fetchall()), key=key)
    assert names == [cur.description[i][0] for i in order]
    return mine, theirs
