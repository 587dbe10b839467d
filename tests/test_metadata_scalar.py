"""Metadata deltas against the format document's algorithm; scalar functions at their edges."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from diagarc.functions import scalar
from diagarc.operators import metadata as meta
from diagarc.operators.flatten import explode_fields, flatten_struct


def expected(docs):
    out, previous, counter = [], None, 0
    for i, doc in enumerate(docs):
        if previous is None or [n for n, _ in doc] != [n for n, _ in previous]:
            counter = 0
            out.append((i, 0, 0, doc))
        else:
            changed = [(n, v) for (n, v), (_, p) in zip(doc, previous) if n in ("start", "end") or v != p]
            if any(n not in ("start", "end") for n, _ in changed):
                counter += 1
                out.append((i, 2, counter, changed))
        previous = doc
    return out


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(5)
    docs = {}
    for i in range(1500):
        k = "hot" if rng.random() < 0.8 else rng.choice("ab")
        names = ["start", "p", "q", "end"] if rng.random() < 0.9 else rng.choice([["start", "p", "end"], ["start", "q", "p", "end"]])
        doc = [(n, str(i) if n in ("start", "end") else rng.choice(["x", "x", "x", "y", None])) for n in names]
        docs.setdefault(k, []).append((i, doc))
    return docs


@pytest.fixture(scope="module")
def deltas(spark, documents):
    rows = [(k, i, doc) for k, v in documents.items() for i, doc in v]
    df = spark.createDataFrame(rows, "k string, t bigint, fields array<struct<name:string,value:string>>")
    return meta.metadata_delta(df, ["k"], ["t"])


def test_metadata_delta(deltas, documents):
    got = {}
    for r in deltas.orderBy("k", "t").collect():
        got.setdefault(r.k, []).append((r.t, r.doc_type, r["index"], [tuple(f) for f in r.fields]))
    want = {k: [(v[i][0], kind, n, doc) for i, kind, n, doc in expected([d for _, d in v])] for k, v in documents.items()}
    assert got == want


@pytest.mark.parametrize("until", [None, 700])
def test_metadata_as_of(deltas, documents, until):
    got = {(r.k, r.name): r.value for r in meta.metadata_as_of(deltas, ["k"], ["t"], until).collect()}
    want = {}
    for k, v in documents.items():
        for i, _, _, doc in expected([d for _, d in v]):
            if until is None or v[i][0] <= until:
                want.update({(k, n): value for n, value in doc})
    assert got == want


def test_metadata_history_ends_as_of_now(deltas):
    history = meta.metadata_history(deltas, ["k"], ["t"], ["p", "q"])
    last = history.groupBy("k").agg(F.max_by(F.struct("p", "q"), "t").alias("v")).collect()
    state = {}
    for r in deltas.orderBy("t").collect():
        for f in r.fields:
            if f.value is not None:
                state[r.k, f.name] = f.value
    assert {r.k: (r.v.p, r.v.q) for r in last} == {k: (state[k, "p"], state[k, "q"]) for k in {k for k, _ in state}}


def test_double_to_i64(spark):
    values = [3.8, -3.8, float("nan"), 1e30, -1e30, 2.0**63, -(2.0**63), 0.0, float("inf"), float("-inf"), 2.0**53]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(scalar.double_to_i64(F.col("v"))).collect()]
    top, bottom = 2**63 - 1, -(2**63)
    assert got == [3, -3, 0, top, bottom, top, bottom, 0, top, bottom, 2**53]


def test_wrapping_arithmetic(spark):
    rng = random.Random(2)
    pairs = [(rng.getrandbits(64) - 2**63, rng.getrandbits(64) - 2**63) for _ in range(300)] + [(2**63 - 1, 1), (-(2**63), -1)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")

    def wrap(n):
        return (n + 2**63) % 2**64 - 2**63

    got = df.select("a", "b", scalar.wrap_sub(F.col("a"), F.col("b")).alias("d")).collect()
    assert all(r.d == wrap(r.a - r.b) for r in got)
    assert df.agg(scalar.wrap_sum(F.col("a"))).first()[0] == wrap(sum(a for a, _ in pairs))


def test_varint_size(spark):
    values = [0, 127, 128, 16383, 16384, 2**63 - 1, -1, -(2**63), 2**56 - 1, 2**56]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    assert [r[0] for r in df.select(scalar.varint_size(F.col("v"))).collect()] == [1, 1, 2, 2, 3, 9, 10, 10, 8, 9]


def test_white_space_is_the_unicode_set(spark):
    every = [(c, chr(c) + "x" + chr(c)) for c in range(1, 0x3100)]
    df = spark.createDataFrame(every, "c int, s string")
    got = {r.c for r in df.filter(F.length(scalar.trim_unicode(F.col("s"))) == 1).collect()}
    assert got == {c for c in range(1, 0x3100) if chr(c).isspace()} - set(range(0x1C, 0x20))


def test_dates_do_not_depend_on_the_session_zone(spark):
    ms = int(np.datetime64("2024-02-29T23:30:00", "ms").astype(int))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(ms,)], "ms bigint")
            assert df.select(scalar.ms_to_date(F.col("ms")).cast("string")).first()[0] == "2024-02-29"
            ntz = df.select(scalar.ntz_to_ms(F.lit("2024-02-29 23:30:00").cast("timestamp_ntz"))).first()[0]
            assert ntz == ms
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_flatten_nested_columns(spark):
    df = spark.sql("""select named_struct('start', timestamp_millis(5), ' a.b ', named_struct('x', 1, 's', 't', 'f', float(2.5)),
        'arr', array(named_struct('y', 1L, 'z', array(true, false))), '  ', named_struct('q', 3), 'dec', 1.5) as d""")
    got = [(r.key_no, r.name, r.bson_type, r.value) for r in explode_fields(flatten_struct(df, "d").drop("d")).orderBy("key_no").collect()]
    assert got == [
        (0, "start", "datetime", 5), (1, "a_b_x", "int32", 1), (2, "a_b_f", "double", 2), (3, "arr_0_y", "int64", 1),
        (4, "arr_0_z_0", "bool", 1), (5, "arr_0_z_1", "bool", 0), (6, "q", "int32", 3), (7, "dec", "decimal128", 0)]


def test_flatten_rejects_other_types(spark):
    with pytest.raises(TypeError):
        flatten_struct(spark.sql("select named_struct('a', cast('x' as binary)) as d"), "d")
