"""Chunk decoding through Spark: known vectors, quirks, malformed input, native against vectorised."""

import random

import bson_build as b
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from diagarc.errors import decode_errors, split_errors
from diagarc.operators import check, decode, long_tables


def docs(spark, bodies):
    return spark.createDataFrame([("p", i, bytearray(x)) for i, x in enumerate(bodies)], "path string, doc_no bigint, body binary")


def series(spark, *bodies, **options):
    rows = decode.series(decode.decode_chunks(docs(spark, bodies), **options)).orderBy("doc_no", "key_no").collect()
    return [(r.doc_no, r["name"], r["values"]) for r in rows]


def errors(spark, *bodies, **options):
    rows = decode.decode_chunks(docs(spark, bodies), mode="permissive", **options).orderBy("doc_no").collect()
    return [r.error and r.error.split(":")[0] for r in rows]


START = {"start": b.int64(1600000000000)}


def test_zero_run_vector(spark):
    body = b.metric({**START, "x": b.int64(42)}, 2, 3, [1, 1, 1, 0, 2])
    assert series(spark, body) == [(0, "start", [1600000000000 + i for i in range(4)]), (0, "x", [42] * 4)]
    rows = decode.samples(decode.decode_chunks(docs(spark, [body]))).orderBy("key_no", "sample_no").collect()
    assert [r.ts_ms for r in rows] == [1600000000000 + i for i in range(4)] * 2
    assert [r.sample_no for r in rows] == [0, 1, 2, 3] * 2


def test_coercion_vector(spark):
    reference = {"start": b.int64(1000), "datetime": b.date(1700000000123), "int32": 42, "int64": b.int64(9999), "double": 3.8,
                 "boolean_true": True, "boolean_false": False}
    got = series(spark, b.metric(reference, 7, 1, [1] * 7))
    assert [v for _, _, v in got] == [[x, x + 1] for x in (1000, 1700000000123, 42, 9999, 3, 1, 0)]


def test_wrapping_deltas(spark):
    body = b.metric({**START, "x": b.int64(2**63 - 1), "y": b.int64(-(2**63))}, 3, 2, [5, 5, 1, -1, -1, 1])
    assert [v for _, _, v in series(spark, body)][1:] == [[2**63 - 1, -(2**63), 2**63 - 1], [-(2**63), 2**63 - 1, -(2**63)]]


def test_last_start_is_the_axis_and_nested_ones_are_not(spark):
    reference = [("start", b.int64(5)), ("x", {"start": b.int64(7)}), ("start", b.int64(9))]
    rows = decode.samples(decode.decode_chunks(docs(spark, [b.metric(reference, 3, 1, [1, 2, 3])]))).collect()
    assert {(r["name"], r.key_no) for r in rows} == {("start", 0), ("x_start", 1), ("start", 2)}
    assert sorted({r.ts_ms for r in rows}) == [9, 12]


def test_axis_out_of_range_has_no_timestamp(spark):
    rows = decode.samples(decode.decode_chunks(docs(spark, [b.metric({"start": b.int64(-5)}, 1, 1, [2**62])]))).orderBy("sample_no").collect()
    assert [(r.ts_ms, r.ts) for r in rows] == [(-5, None), (2**62 - 5, None)]


def test_no_deltas_and_no_size_check(spark):
    assert series(spark, b.metric({**START, "x": 7}, 2, 0, [], declared=1)) == [(0, "start", [1600000000000]), (0, "x", [7])]


def test_declared_key_count_is_not_enforced(spark):
    body = b.metric({**START, "x": 7}, 99, 1, [1, 1])
    assert len(series(spark, body)) == 2
    row = check.shape_audit(decode.decode_chunks(docs(spark, [body]), want="keys")).first()
    assert (row.n_keys, row.n_keys_found, row.keys_match) == (99, 2, False)


def test_undecodable_tail_after_last_token_passes(spark):
    assert errors(spark, b.metric(START, 1, 1, [1], tail=b"\x80\x80")) == [None]


def test_malformed_documents(spark):
    ok = b.doc({"_id": b.date(0), "type": 1, "data": b.binary(b"abcd" + b"junk")})
    cases = {
        "not_metric": b.doc({"_id": b.date(0), "type": 0, "data": b.binary(b"x")}),
        "bad_id": b.doc({"_id": 1, "type": 1, "data": b.binary(b"x")}),
        "no_data": b.doc({"_id": b.date(0), "type": 1, "data": "x"}),
        "data_too_small": b.doc({"_id": b.date(0), "type": 1, "data": b.binary(b"abc")}),
        "inflate_failed": ok,
        "short_payload": b.doc({"_id": b.date(0), "type": 1, "data": b.binary(b.packed(b"abc"))}),
        "reference_too_large": b.doc({"_id": b.date(0), "type": 1, "data": b.binary(b.packed(b"\xff\0\0\0abc"))}),
        "bad_reference": b.doc({"_id": b.date(0), "type": 1, "data": b.binary(b.packed(b"\x06\0\0\0ab" + b"\0" * 8))}),
        "counts_missing": b.doc({"_id": b.date(0), "type": 1, "data": b.binary(b.packed(b.doc(START) + b"\0" * 7))}),
        "empty_key": b.metric({**START, "": 1}, 2, 0, []),
        "unhandled_type": b.metric({**START, "x": None}, 1, 0, []),
        "bad_varint": b.metric(START, 1, 3, [1, 0]),
        "zero_run_left": b.metric(START, 1, 3, [1, 0, 2]),
        "tokens_left": b.metric(START, 1, 1, [1, 1]),
        "no_start": b.metric({"x": 1}, 1, 1, [1]),
        "bad_bson": b"\x05\0\0\0\x01",
    }
    assert errors(spark, *cases.values()) == list(cases)
    # Key-only reads see the same errors, since they check the tokens too.
    assert errors(spark, *cases.values(), want="keys") == list(cases)
    good = b.metric(START, 1, 1, [1])
    mixed = decode.decode_chunks(docs(spark, [good, *cases.values(), good]), mode="permissive")
    assert decode.samples(mixed).count() == 4
    fine, bad = split_errors(mixed)
    assert fine.count() == 2 and bad.count() == len(cases)
    assert {r.error_class: r.n_rows for r in decode_errors(mixed).collect()} == {k: 1 for k in cases}


def test_token_errors_win_over_a_missing_axis(spark):
    assert errors(spark, b.metric({"x": 1}, 1, 2, [1])) == ["bad_varint"]


@pytest.mark.parametrize("use", [lambda c: c.select("path"), decode.samples, decode.series, check.check_totals])
def test_failfast_is_never_pruned(spark, use):
    bad = docs(spark, [b.metric(START, 1, 1, [1]), b.metric(START, 1, 1, [])])
    with pytest.raises(PySparkException, match="bad_varint"):
        use(decode.decode_chunks(bad)).collect()


def test_names_keep_only_those_and_the_axis(spark):
    body = b.metric({**START, "x": 7, "y": 8}, 3, 2, [1, 2, 0, 0, 4, 5, 6])
    rows = decode.samples(decode.decode_chunks(docs(spark, [body]), names=["y"])).orderBy("sample_no").collect()
    assert [(r["name"], r.key_no, r.ts_ms - 1600000000000, r.value) for r in rows] == [("y", 2, 0, 8), ("y", 2, 1, 13), ("y", 2, 3, 19)]


def random_chunk(rng, i):
    n_keys, n_deltas = rng.randrange(1, 6), rng.choice([0, 1, 2, 7, 30])
    deltas = [rng.choice([0, 0, 0, 0, 1, -1, 2**63, rng.getrandbits(64)]) for _ in range(n_keys * n_deltas)]
    tokens, run = [], 0
    for d in [*deltas, None]:
        if d == 0:
            run += 1
            continue
        while run:  # split a run now and then, so that runs touch
            part = rng.randrange(1, run + 1)
            tokens += [0, part - 1]
            run -= part
        if d is not None:
            tokens.append(d)
    reference = {"start": b.int64(1000 + i), **{f"k{j}": b.int64(rng.getrandbits(63)) for j in range(n_keys - 1)}}
    bases = [int.from_bytes(v[1:], "little", signed=True) for v in reference.values()]
    want = []
    for k, base in enumerate(bases):
        row = [base]
        for d in deltas[k * n_deltas:(k + 1) * n_deltas]:
            row.append((row[-1] + d + 2**63) % 2**64 - 2**63)
        want.append(row)
    return b.metric(reference, n_keys, n_deltas, tokens), want


def test_random_chunks_native_and_vectorised(spark):
    rng = random.Random(7)
    bodies, want = zip(*(random_chunk(rng, i) for i in range(60)))
    source = docs(spark, bodies).cache()
    flat = [(i, k, v) for i, keys in enumerate(want) for k, v in enumerate(keys)]
    chunks = decode.decode_chunks(source)
    got = decode.series(chunks).orderBy("doc_no", "key_no").collect()
    assert [(r.doc_no, r.key_no, r["values"]) for r in got] == flat

    def dense(rows):
        return sorted((r.doc_no, r.key_no, r.sample_no, r.value) for r in rows.select("doc_no", "key_no", "sample_no", "value").collect())

    cells = [(i, k, s, v) for i, k, vs in flat for s, v in enumerate(vs)]
    assert dense(decode.samples(chunks)) == cells
    keys = decode.chunk_keys(source)
    assert dense(long_tables.densify(long_tables.delta_decode(decode.change_points(keys)))) == cells
    # Token-level operators on the raw token table.
    tokens = decode.chunk_tokens(source)
    native = sorted(map(tuple, long_tables.expand_zero_runs(tokens).select("doc_no", "key_no", "sample_no", "delta").collect()))
    points = keys.select("doc_no", "key_no", F.explode("points").alias("p")).select("doc_no", "key_no", "p.*")
    assert native == sorted(map(tuple, points.collect()))
    assert long_tables.stream_complete(tokens).filter("error is not null").count() == 0
    # Dense -> series -> dense, and the axis join.
    again = long_tables.samples_of(long_tables.series_of(decode.samples(chunks)))
    assert dense(again) == cells
    timed = long_tables.time_axis(long_tables.densify(long_tables.delta_decode(decode.change_points(keys))))
    want_ts = {(r.doc_no, r.key_no, r.sample_no): r.ts_ms for r in decode.samples(chunks).collect()}
    assert {(r.doc_no, r.key_no, r.sample_no): r.ts_ms for r in timed.collect()} == want_ts


def test_stream_complete_classes(spark):
    bodies = [b.metric(START, 1, 3, t) for t in ([1, 0], [1], [1, 0, 2], [0, 2**64 - 1], [1, 1, 1, 1], [1, 1, 1])]
    rows = long_tables.stream_complete(decode.chunk_tokens(docs(spark, bodies))).orderBy("doc_no").collect()
    assert [r.error for r in rows] == ["bad_varint", "bad_varint", "zero_run_left", "zero_run_left", "tokens_left", None]


def test_value_changes_cover_every_sample(spark, event_docs):
    chunks = decode.decode_chunks(event_docs)
    changes = decode.value_changes(chunks).groupBy("path", "doc_no", "key_no").agg(F.sum("n_samples").alias("n"))
    dense = decode.samples(chunks).groupBy("path", "doc_no", "key_no").agg(F.count("*").alias("m"))
    assert changes.join(dense, ["path", "doc_no", "key_no"]).filter("n <> m").count() == 0


def test_no_shuffle_between_documents_and_samples(spark, event_docs):
    plan = decode.samples(decode.decode_chunks(docs(spark, [])))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_large_chunk_shape(spark):
    """3479 keys by 300 samples, two chunks."""
    reference = {"start": b.date(1600000000000), **{f"k{i}": b.int64(i) for i in range(3478)}}
    tokens = [1000] * 299 + [0, 3478 * 299 - 1]
    bodies = [b.metric(reference, 3479, 299, tokens)] * 2
    chunks = decode.decode_chunks(docs(spark, bodies))
    row = decode.samples(chunks).agg(F.count("*").alias("n"), F.countDistinct("doc_no", "key_no").alias("k")).first()
    assert (row.n, row.k) == (2 * 3479 * 300, 2 * 3479)
    audit = check.axis_audit(chunks).collect()
    assert [(a.n_samples, a.n_violations, a.mean_step_ms) for a in audit] == [(300, 0, 1000.0)] * 2
