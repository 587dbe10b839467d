"""K1, K2: remote-write requests and their delivery."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diagarc.operators.decode import decoded
from diagarc.operators.labels import NAME_LABEL, SOURCE_LABEL, drop_empty_series, label_array, remote_samples, with_labels
from diagarc.plans.shared import run_dir
from diagarc.sources import wire

# Path and headers of the public remote-write protocol.
WRITE_PATH = "/api/v1/write"
HEADERS = {
    "Content-Encoding": "snappy",
    "Content-Type": "application/x-protobuf",
    "X-Prometheus-Remote-Write-Version": "0.1.0",
}


PAYLOADS = "path string, doc_no bigint, n_series bigint, n_plain_bytes bigint, payload binary"
_FLUSH_BYTES = 8 << 20


def write_requests(chunks: DataFrame, extras=()) -> DataFrame:
    """K1: one request per decoded chunk with all its series, in key order.

    A chunk is one row, so its request is an array expression: nothing moves. Chunks
    without series or samples give no row.
    """
    def one(k):
        stops = F.concat(F.slice(k["at"], F.lit(2), F.size(k["at"])), F.array(F.col("n_deltas").cast("int") + 1))
        runs = F.zip_with(k["at"], stops, lambda a, b: b - a)
        values = F.flatten(F.zip_with(k["val"], runs, lambda v, n: F.array_repeat(v, n)))
        return F.struct(label_array(k["name"], extras).alias("labels"), remote_samples(values, F.col("axis")).alias("samples"))

    rows = decoded(chunks).filter((F.size("keys") > 0) & (F.size("axis") > 0))
    return rows.select("path", "doc_no", F.transform("keys", one).alias("timeseries"))


def requests_of(series: DataFrame, extras=()) -> DataFrame:
    """K1 on a stored ``series`` table: one shuffle on the chunk, a group the writer bounds."""
    labelled = with_labels(drop_empty_series(series), extras)
    item = F.struct("key_no", "labels", remote_samples(F.col("values"), F.col("ts_ms")).alias("samples"))
    grouped = labelled.groupBy("path", "doc_no").agg(F.array_sort(F.collect_list(item)).alias("items"))
    timeseries = F.transform("items", lambda i: F.struct(i["labels"].alias("labels"), i["samples"].alias("samples")))
    return grouped.select("path", "doc_no", timeseries.alias("timeseries"))


def chunk_payloads(chunks: DataFrame, extras=()) -> DataFrame:
    """Payload bytes of each decoded chunk: those of :func:`write_requests` without the nested rows.

    The change points of a chunk are spread over its samples in the task that builds
    the payload, so dense samples exist nowhere else.
    """
    rest = [(n, v) for n, v in [SOURCE_LABEL, *extras]]

    def run(batches):
        for b in batches:
            first, requests = 0, []
            for i, (axis, keys) in enumerate(zip(b.column("axis"), b.column("keys"))):
                fields, times = keys.values, axis.values.to_numpy(zero_copy_only=False)
                at, val = fields.field("at"), fields.field("val")
                starts = at.flatten().to_numpy(zero_copy_only=False)
                values = val.flatten().to_numpy(zero_copy_only=False)
                # A change lasts until the next one of its key, the last one to the end.
                lasts = np.diff(np.append(starts, 0))
                lasts[lasts <= 0] += len(times)
                dense = np.repeat(values, lasts).reshape(len(fields), len(times))
                blocks = _sample_blocks(dense, times)
                tail = b"".join(_label(n, v) for n, v in rest)
                names = fields.field("name").to_pylist()
                requests.append(_request([_label(NAME_LABEL, n) + tail for n in names], blocks))
                if sum(len(r[2]) for r in requests) > _FLUSH_BYTES:
                    yield _payload_batch(b, first, requests)
                    first, requests = i + 1, []
            yield _payload_batch(b, first, requests)

    rows = decoded(chunks).filter((F.size("keys") > 0) & (F.size("axis") > 0))
    return rows.select("path", "doc_no", "axis", "keys").mapInArrow(run, PAYLOADS)


def _payload_batch(b, first, requests):
    """The requests of the rows of ``b`` from number ``first`` on."""
    counts, sizes, payload = zip(*requests) if requests else ((), (), ())
    rows = b.slice(first, len(requests))
    return pa.RecordBatch.from_arrays(
        [rows.column("path"), rows.column("doc_no"), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(payload, pa.binary())],
        names=["path", "doc_no", "n_series", "n_plain_bytes", "payload"],
    )


def _request(labels: list[bytes], blocks: list[bytes]) -> tuple[int, int, bytes]:
    """(series, plain bytes, payload) of a request of series given as label and sample messages."""
    plain = b"".join(_field(0x0A, head + block) for head, block in zip(labels, blocks))
    return len(labels), len(plain), pa.compress(plain, codec="snappy", asbytes=True)


def _label(name: str, value: str) -> bytes:
    return _field(0x0A, _field(0x0A, name.encode()) + _field(0x12, value.encode()))


def _sample_blocks(values: np.ndarray, times: np.ndarray) -> list[bytes]:
    """Sample messages of each row of ``values``; the time bytes are the same in all of them."""
    raw = wire.write_varints(times.view(np.uint64))
    stops = np.flatnonzero(np.frombuffer(raw, np.uint8) < 0x80) + 1
    sizes = np.diff(np.concatenate(([0], stops)))
    heads = [bytes((0x12, 10 + size, 0x09)) for size in sizes.tolist()]
    tails = [b"\x10" + raw[stop - size : stop] for size, stop in zip(sizes.tolist(), stops.tolist())]
    template = np.frombuffer(b"".join(h + bytes(8) + t for h, t in zip(heads, tails)), np.uint8)
    first = np.cumsum(sizes + 12) - (sizes + 12) + 3
    where = (first[:, None] + np.arange(8)).ravel()
    out = np.tile(template, (len(values), 1))
    out[:, where] = values.astype("<f8").view(np.uint8).reshape(len(values), -1)
    return [row.tobytes() for row in out]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(tag: int, payload: bytes) -> bytes:
    return bytes((tag,)) + _varint(len(payload)) + payload


def encode_requests(requests: DataFrame) -> DataFrame:
    """Payload bytes (protobuf, raw snappy) of each row of :func:`write_requests`."""

    def run(batches):
        for b in batches:
            first, out = 0, []
            for i, request in enumerate(b.column("timeseries")):
                heads, blocks = [], []
                for labels, samples in zip(request.values.field("labels"), request.values.field("samples")):
                    points = samples.values
                    values, times = (points.field(c).to_numpy(zero_copy_only=False) for c in ("value", "timestamp"))
                    heads.append(b"".join(_label(x["name"], x["value"]) for x in labels.as_py()))
                    blocks += _sample_blocks(values[None, :], times)
                out.append(_request(heads, blocks))
                if sum(len(r[2]) for r in out) > _FLUSH_BYTES:
                    yield _payload_batch(b, first, out)
                    first, out = i + 1, []
            yield _payload_batch(b, first, out)

    return requests.select("path", "doc_no", "timeseries").mapInArrow(run, PAYLOADS)


def remote_write(payloads: DataFrame, base_url: str, send) -> DataFrame:
    """K2: deliver each payload to ``{base_url}/api/v1/write``, now, and return the receipts.

    ``payloads`` come from :func:`chunk_payloads`, or from :func:`encode_requests`.

    ``send(url, headers, payload)`` returns ``(status, text)`` and runs in executor
    tasks, once for each payload. A status other than 2xx fails the task; Spark retries it, so
    delivery is at least once after a failure, and a retried request has the same bytes. The
    receipts are a table in the shared folder: reading them, in part or again, sends nothing.
    """
    url = base_url.rstrip("/") + WRITE_PATH
    schema = "path string, doc_no bigint, n_series bigint, n_plain_bytes bigint, n_bytes bigint, status int"

    def run(batches):
        for b in batches:
            status = []
            for payload in b.column("payload"):
                code, text = send(url, HEADERS, payload.as_py())
                if not 200 <= code < 300:
                    raise RuntimeError(f"remote write to {url} failed: {code} - {text}")
                status.append(code)
            sizes = [len(p.as_py()) for p in b.column("payload")]
            yield pa.RecordBatch.from_arrays(
                [b.column("path"), b.column("doc_no"), b.column("n_series"), b.column("n_plain_bytes"), pa.array(sizes, pa.int64()),
                 pa.array(status, pa.int32())],
                names=["path", "doc_no", "n_series", "n_plain_bytes", "n_bytes", "status"],
            )

    spark = payloads.sparkSession
    receipts = run_dir(spark, "receipts")
    payloads.mapInArrow(run, schema).write.parquet(receipts)
    return spark.read.schema(schema).parquet(receipts)
