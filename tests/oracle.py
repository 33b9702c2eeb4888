"""Run a registered query on Spark and its SQL on DuckDB and compare the rows exactly."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr), [names[i] for i in order]


def compare(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    frame = query(spark, sf_dir)
    mine, my_names = _sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs, their_names = _sorted_rows(names, cursor.fetchall())
    if my_names != their_names:
        return f"columns {my_names} vs {their_names}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows vs {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{my_names}: {a} vs {b}"
    return None
