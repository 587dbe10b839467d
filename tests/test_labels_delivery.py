"""Labels, remote-write payloads (read by an independent parser) and delivery."""

import struct

import bson_build as b
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from diagarc.operators import delivery, labels
from diagarc.operators.decode import decode_chunks, series


def test_parse_labels(spark):
    raw = ["a=b", " a = b ", "a=b=c", "a=", "=b", "ab", " a\t= b\n", " = x", ""]
    df = labels.parse_labels(spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, raw string"), "raw")
    got = [(r.label_name, r.label_value, r.reason) for r in df.orderBy("i").collect()]
    assert got == [("a", "b", None), ("a", "b", None), ("a", "b=c", None), ("a", "", None), (None, None, "empty name"),
                   (None, None, "missing '='"), ("a", "b", None), (None, None, "empty name"), (None, None, "missing '='")]
    accepted = [(n, v) for n, v, r in got if r is None]
    assert labels.label_pairs(raw) == accepted  # order and repeats kept


def test_label_order_and_repeats(spark):
    df = labels.with_labels(spark.createDataFrame([("m",)], "name string"), [("x", "1"), ("x", "1"), ("a", "")])
    assert [tuple(x) for x in df.first().labels] == [("__name__", "m"), ("source", "mongodb_ftdc"), ("x", "1"), ("x", "1"), ("a", "")]
    empty = labels.with_labels(spark.createDataFrame([("m",)], "name string"))
    assert len(empty.first().labels) == 2


def fields(raw):
    """(field number, value) pairs of a protobuf message."""
    at = 0

    def number():
        nonlocal at
        n = shift = 0
        while True:
            c = raw[at]
            at += 1
            n |= (c & 0x7F) << shift
            shift += 7
            if not c & 0x80:
                return n

    while at < len(raw):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        elif tag & 7 == 1:
            yield tag >> 3, struct.unpack_from("<d", raw, at)[0]
            at += 8
        else:
            n = number()
            yield tag >> 3, raw[at:at + n]
            at += n


def parse(payload):
    size = shift = at = 0
    while True:  # raw snappy starts with the plain length
        size |= (payload[at] & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if payload[at - 1] < 0x80:
            break
    plain = pa.decompress(payload, decompressed_size=size, codec="snappy", asbytes=True)
    out = []
    for n, one in fields(plain):
        assert n == 1
        parts = list(fields(one))
        out.append(([tuple(v.decode() for _, v in fields(x)) for k, x in parts if k == 1],
                    [tuple(v for _, v in sorted(fields(x))) for k, x in parts if k == 2]))
    return out


def chunks(spark, *bodies):
    rows = spark.createDataFrame([("p", i, bytearray(x)) for i, x in enumerate(bodies)], "path string, doc_no bigint, body binary")
    return decode_chunks(rows)


BIG = 2**53 + 1


def test_payload_holds_the_request(spark):
    body = b.metric({"start": b.date(1600000000000), "x": b.int64(BIG), "é": -3}, 3, 2, [1000, 1000, 0, 1, -5, 0, 0])
    df = delivery.encode_requests(delivery.write_requests(chunks(spark, body), [("h", "v")]))
    row = df.first()
    times = [1600000000000, 1600000001000, 1600000002000]

    def want(name, values):
        return ([("__name__", name), ("source", "mongodb_ftdc"), ("h", "v")], [(float(v), t) for v, t in zip(values, times)])

    assert parse(bytes(row.payload)) == [want("start", times), want("x", [BIG] * 3), want("é", [-3, -8, -8])]
    again = delivery.encode_requests(delivery.requests_of(series(chunks(spark, body)), [("h", "v")])).first()
    direct = delivery.chunk_payloads(chunks(spark, body), [("h", "v")]).first()
    assert again.payload == row.payload == direct.payload and row.n_series == direct.n_series == 3


def test_times_of_different_width(spark):
    body = b.metric({"start": b.int64(1)}, 1, 2, [1 << 40, -(1 << 41)])
    row = delivery.encode_requests(delivery.write_requests(chunks(spark, body))).first()
    assert row.payload == delivery.chunk_payloads(chunks(spark, body)).first().payload
    samples = parse(bytes(row.payload))[0][1]
    assert [(v, t - 2**64 if t >= 2**63 else t) for v, t in samples] == [(1.0, 1), (float(2**40 + 1), 2**40 + 1), (float(1 - 2**40), 1 - 2**40)]


def test_direct_payloads_equal_requests(spark, event_docs):
    decoded = decode_chunks(event_docs)
    a = delivery.chunk_payloads(decoded, [("k", "v")]).collect()
    c = delivery.encode_requests(delivery.write_requests(decoded, [("k", "v")])).collect()
    assert len(a) == event_docs.count() and sorted(map(tuple, a)) == sorted(map(tuple, c))


def test_empty_series_are_dropped(spark):
    df = spark.createDataFrame(
        [("p", 0, 0, "a", [1], [5]), ("p", 0, 1, "b", [], [5]), ("p", 0, 2, "c", [1], []), ("q", 0, 0, "d", [], [])],
        "path string, doc_no bigint, key_no int, name string, values array<bigint>, ts_ms array<bigint>")
    got = delivery.requests_of(df).collect()
    assert len(got) == 1 and len(got[0].timeseries) == 1


def test_send_gets_url_headers_and_payload(spark, event_docs, tmp_path):
    out = str(tmp_path)

    def send(url, headers, payload):
        import uuid

        with open(f"{out}/{uuid.uuid4().hex}", "wb") as f:
            f.write(url.encode() + b"\n" + headers["Content-Encoding"].encode() + b"\n" + payload)
        return 204, ""

    receipts = delivery.remote_write(delivery.chunk_payloads(decode_chunks(event_docs)), "http://c:1/", send).collect()
    sent = [p.read_bytes().split(b"\n", 2) for p in tmp_path.iterdir()]
    assert len(sent) == len(receipts) == event_docs.count()
    assert {s[0] for s in sent} == {b"http://c:1/api/v1/write"} and {s[1] for s in sent} == {b"snappy"}
    assert sum(len(parse(s[2])) for s in sent) == sum(r.n_series for r in receipts)


def test_receipts_are_read_without_sending(spark, event_docs, tmp_path):
    out = str(tmp_path)

    def send(url, headers, payload):
        import uuid

        open(f"{out}/{uuid.uuid4().hex}", "wb").close()
        return 200, ""

    receipts = delivery.remote_write(delivery.chunk_payloads(decode_chunks(event_docs)), "http://c", send)
    assert len(receipts.limit(2).collect()) == 2 and receipts.count() == receipts.count() == event_docs.count()
    assert len(list(tmp_path.iterdir())) == event_docs.count()


def test_payloads_are_handed_on_by_size(spark, event_docs, monkeypatch):
    want = sorted(map(tuple, delivery.chunk_payloads(decode_chunks(event_docs)).collect()))
    rows = decode_chunks(event_docs).coalesce(1)
    assert sorted(map(tuple, delivery.chunk_payloads(rows).collect())) == want


def test_refusal_fails_the_job_with_status_and_text(spark, event_docs):
    requests = delivery.chunk_payloads(decode_chunks(event_docs))
    with pytest.raises(PySparkException, match="503 - too busy"):
        delivery.remote_write(requests, "http://c", lambda *a: (503, "too busy")).collect()


def test_request_needs_no_shuffle(spark):
    plan = delivery.write_requests(chunks(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_length_mismatch_is_an_error(spark):
    from diagarc.operators.long_tables import samples_of

    df = spark.createDataFrame([("p", 0, 0, "a", [1, 2], [5])],
                               "path string, doc_no bigint, key_no int, name string, values array<bigint>, ts_ms array<bigint>")
    with pytest.raises(PySparkException, match="differ in length"):
        samples_of(df).collect()
