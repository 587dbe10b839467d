"""Ordered steps with one group that holds most rows, against a plain reading in Python."""

import random

import pytest
from pyspark.sql import functions as F

from diagarc.operators import encode, long_tables
from diagarc.plans import ordered


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = []
    for i in range(4000):
        key = "hot" if rng.random() < 0.7 else rng.choice(["a", "b", None, "z"])
        data.append((key, rng.randrange(500), i, rng.choice([None, 1, 2, 3]), rng.getrandbits(63)))
    return data


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k string, t int, id bigint, v bigint, big bigint").repartition(8)


def groups(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        out.setdefault(r[0], []).append(r)
    return out


def test_hot_group_spans_slices(df):
    sliced = ordered.slice_rows(df, ["k"], ["t", "id"], n=16)
    assert sliced.filter("k = 'hot'").select(ordered.SLICE).distinct().count() > 5
    assert sliced.groupBy(ordered.SLICE).count().agg(F.max("count")).first()[0] < 1000


def test_row_numbers(df, rows):
    got = {r.id: r.row_no for r in ordered.number_rows(df, ["k"], ["t", "id"], n=16).collect()}
    assert got == {r[2]: i + 1 for g in groups(rows).values() for i, r in enumerate(g)}


def test_global_row_numbers(df, rows):
    got = {r.id: r.row_no for r in ordered.number_rows(df, [], ["t", "id"], n=16).collect()}
    assert got == {r[2]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2])))}


def test_previous_row(df, rows):
    out = ordered.previous_row(df, ["k"], ["t", "id"], ["id", "v"], n=16).collect()
    got = {r.id: r.previous and tuple(r.previous) for r in out}
    assert got == {r[2]: (g[i - 1][2], g[i - 1][3]) if i else None for g in groups(rows).values() for i, r in enumerate(g)}


def test_running(df, rows):
    outs = {"s": ("sum", "v"), "m": ("max", "v"), "last": ("last", "v")}
    got = {r.id: (r.s, r.m, r["last"]) for r in ordered.running(df, ["k"], ["t", "id"], outs, n=16).collect()}
    want = {}
    for g in groups(rows).values():
        s = m = last = None
        for r in g:
            if r[3] is not None:
                s, m, last = (s or 0) + r[3], max(m or 0, r[3]), r[3]
            want[r[2]] = (s, m, last)
    assert got == want


def test_delta_encode_sliced_equals_bounded(spark, df, rows):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sliced = {r.id: r.delta for r in long_tables.delta_encode(df, ["k"], ["t", "id"], "big").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    plain = {r.id: r.delta for r in long_tables.delta_encode(df, ["k"], ["t", "id"], "big", bounded=True).collect()}
    want = {r[2]: r[4] - g[i - 1][4] if i else None for g in groups(rows).values() for i, r in enumerate(g)}
    assert sliced == plain == want


def test_chunk_boundaries(df, rows):
    marked = df.withColumn("schema", F.coalesce("v", F.lit(0)) > 1)
    got = {r.id: (r.doc_no, r.sample_no) for r in encode.chunk_boundaries(marked, ["k"], ["t", "id"], "schema", 3).collect()}
    want = {}
    for g in groups(rows).values():
        doc, n, schema = -1, 0, None
        for r in g:
            s = (r[3] or 0) > 1
            if s is not schema or n == 3:
                doc, n, schema = doc + 1, 0, s
            want[r[2]] = (doc, n)
            n += 1
    assert got == want


def test_fill_chunks(df, rows):
    got = {r.id: (r.doc_no, r.sample_no) for r in encode.fill_chunks(df, ["k"], ["t", "id"], 7).collect()}
    assert got == {r[2]: divmod(i, 7) for g in groups(rows).values() for i, r in enumerate(g)}
