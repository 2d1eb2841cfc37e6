"""Run one registered query in Spark and its SQL in DuckDB, and compare."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.12g}" if v else "0"
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return repr(v)
    if isinstance(v, int):
        return repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def compare(spark, con, query, sf_dir: str) -> tuple[bool, str]:
    df = query.run(spark, sf_dir)
    columns = sorted(df.columns)
    got = df.select(*[f"`{c}`" for c in columns]).collect()
    if query.sql is None:
        return len(got) > 0, f"rows only: {len(got)}"
    res = con.execute(query.sql)
    names = [d[0] for d in res.description]
    if sorted(names) != columns:
        return False, f"columns {columns} != {sorted(names)}"
    order = [names.index(c) for c in columns]
    want = [tuple(r[i] for i in order) for r in res.fetchall()]
    types = dict(df.dtypes)
    a = sorted(tuple(_norm(v) for v in r) for r in got)
    b = sorted(tuple(_norm(v) for v in r) for r in want)
    # Whole numbers that one side types as a float compare by value.
    if a == b:
        exact = sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
        return True, f"{len(a)} rows" + ("" if exact else " (floats differ in the last digits or types)")
    if len(a) != len(b):
        return False, f"{len(a)} rows != {len(b)}; first {a[:1]} / {b[:1]}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return False, f"{len(bad)} of {len(a)} rows differ, e.g. {bad[0]} types {types}"
