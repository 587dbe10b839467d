"""Run catalogue queries in Spark and DuckDB and compare whole results."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(directory):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{directory}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, int):
        return str(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows), sorted(columns)


def compare(spark_df, con, sql):
    """None when equal, else a short description."""
    got, got_columns = rows_of(spark_df.columns, spark_df.collect())
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    want, want_columns = rows_of(columns, cur.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; {set(got) - set(want)} / {set(want) - set(got)}"[:600]
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
