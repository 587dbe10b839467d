"""Archive sources: files to documents, and document-level tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from diagarc.errors import apply_mode
from diagarc.sources import wire

ARCHIVE_DOCS = (
    "path string, doc_no bigint, byte_offset bigint, doc_type int, id_ms bigint, body binary, error string"
)
_FILES = "path string, modificationTime timestamp, length bigint, content binary"
METADATA, METRIC, METADATA_DELTA = 0, 1, 2

# File name grammar of closed archives, UTC start time then uniquifier.
ARCHIVE_GLOB = "metrics.*Z-*"
_FILE_TIME = r"metrics\.(\d{4}-\d{2}-\d{2}T\d{2}-\d{2}-\d{2})Z-(\d{5,})$"


def archive_file_time(path="path"):
    """(start timestamp_ntz in UTC, uniquifier) of an archive path; NULL for other names."""
    stamp = F.regexp_extract(path, _FILE_TIME, 1)
    start = F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd'T'HH-mm-ss")).cast("timestamp_ntz")
    number = F.regexp_extract(path, _FILE_TIME, 2)
    return start, F.when(number != "", number.cast("int"))


def list_archives(spark: SparkSession, path, since=None, until=None, interim=False, stream=False, **options):
    """``binaryFile`` rows of closed archives (or all files with ``interim``).

    ``since`` / ``until`` compare the time in the file name. They are filters on
    ``_metadata.file_name``, which Spark applies while it lists files: what they exclude
    is never opened.
    """
    reader = (spark.readStream.schema(_FILES) if stream else spark.read).format("binaryFile").options(**options)
    if not interim:
        reader = reader.option("pathGlobFilter", ARCHIVE_GLOB)
    files = reader.load(path)
    start, _ = archive_file_time("_metadata.file_name")
    if since is not None:
        files = files.filter(start >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        files = files.filter(start < F.lit(until).cast("timestamp_ntz"))
    return files.select("path", "length", "content")


def _frame_batches(batches):
    schema = pa.schema([
        ("path", pa.string()), ("doc_no", pa.int64()), ("byte_offset", pa.int64()), ("doc_type", pa.int32()),
        ("id_ms", pa.int64()), ("body", pa.binary()), ("error", pa.string()),
    ])
    for batch in batches:
        paths = batch.column("path")
        for i in range(batch.num_rows):
            content = batch.column("content")[i].as_py()
            docs = list(wire.frame(content))
            if not docs:
                continue
            offsets, stops, types, ids, errors = zip(*docs)
            n = len(docs)
            # Documents lie back to back, so the file's own bytes are the value buffer.
            bounds = np.array([*offsets, stops[-1]], np.int32)
            body = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(bounds), pa.py_buffer(content)])
            yield pa.RecordBatch.from_arrays([
                pa.array([paths[i].as_py()] * n, pa.string()), pa.array(np.arange(n)),
                pa.array(offsets, pa.int64()), pa.array(types, pa.int32()), pa.array(ids, pa.int64()),
                body, pa.array(errors, pa.string()),
            ], schema=schema)


def frame_archives(files: DataFrame) -> DataFrame:
    """S1 + S2: cut ``content`` of each file into one row per document."""
    return files.select("path", "content").mapInArrow(_frame_batches, ARCHIVE_DOCS)


def read_archives(spark: SparkSession, path, mode="failfast", spread: int | None = None, **options) -> DataFrame:
    """Documents of all archives under ``path``.

    Archives are closed at a size cap, so a file is a small unit of work and documents stay in
    the task that read them. ``spread`` hashes compressed documents over that many tasks
    instead, for inputs of few or long files. The plan depends on this argument alone, and
    nothing is listed or run to make it.
    """
    docs = apply_mode(frame_archives(list_archives(spark, path, **options)), mode)
    return docs if spread is None else spread_docs(docs, spread)


def spread_docs(docs: DataFrame, n: int) -> DataFrame:
    """Hash documents over ``n`` tasks; a third of them in one file still spreads evenly.

    The count is explicit because a compressed chunk unfolds about a hundredfold:
    coalescing by shuffled bytes would put all decoding into a few tasks.
    """
    return docs.repartition(n, "path", "doc_no")


def metric_docs(docs: DataFrame) -> DataFrame:
    """S3: metric documents, plus unreadable ones so that their errors are not lost."""
    is_metric = F.col("doc_type") == METRIC
    return docs.filter(is_metric | F.col("error").isNotNull() if "error" in docs.columns else is_metric)


def first_metric_docs(docs: DataFrame) -> DataFrame:
    """Bytes and JSON of the first metric document of each archive.

    The rank filter becomes a per-task limit before the shuffle, so one document
    per task and archive moves, never a whole archive.
    """
    first = (
        docs.filter(F.col("doc_type") == METRIC)
        .withColumn("rank", F.row_number().over(W.partitionBy("path").orderBy("doc_no")))
        .filter("rank = 1")
        .drop("rank")
    )
    return document_json(first)


def document_json(docs: DataFrame) -> DataFrame:
    """JSON text of each document next to its bytes."""
    schema = "path string, doc_no bigint, id_ms bigint, body binary, json string"

    def run(batches):
        for b in batches:
            texts = []
            for body in b.column("body"):
                raw = body.as_py()
                texts.append(wire.to_json(wire.plain_document(raw, 0, len(raw))))
            yield pa.RecordBatch.from_arrays(
                [b.column("path"), b.column("doc_no"), b.column("id_ms"), b.column("body"), pa.array(texts, pa.string())],
                names=["path", "doc_no", "id_ms", "body", "json"],
            )

    return docs.select("path", "doc_no", "id_ms", "body").mapInArrow(run, schema)


def doc_outline(docs: DataFrame) -> DataFrame:
    """Outline of each document; for metric documents, of their reference document.

    Rows are numbered by ``ord`` within the document. Long strings are shortened
    here, in a native expression, to 47 characters and dots.
    """
    schema = "path string, doc_no bigint, ord int, depth int, key string, type string, value string, n_items bigint"
    names = ["path", "doc_no", "ord", "depth", "key", "type", "value", "n_items"]

    def run(batches):
        for b in batches:
            out = []
            for path, doc_no, doc_type, body in zip(*(b.column(c).to_pylist() for c in ("path", "doc_no", "doc_type", "body"))):
                doc = wire.open_chunk(body)[3] if doc_type == METRIC else body
                for i, line in enumerate(wire.outline(doc, 0, len(doc))):
                    out.append((path, doc_no, i, *line))
            cols = list(zip(*out)) or [[]] * len(names)
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    rows = docs.select("path", "doc_no", "doc_type", "body").mapInArrow(run, schema)
    is_long = (F.col("type") == "string") & (F.octet_length("value") > 50)
    preview = F.when(is_long, F.concat(F.substring("value", 1, 47), F.lit("...")))
    preview = preview.when(F.col("type") == "array", F.concat(F.lit("[Array with "), "n_items", F.lit(" items]")))
    return rows.select(
        "path", "doc_no", "ord", "depth", "key", "type", preview.otherwise(F.col("value")).alias("preview"), "n_items"
    )


def metadata(docs: DataFrame, mode="failfast") -> DataFrame:
    """Metadata documents and deltas as ordered (name, JSON value) fields.

    Documents of type 0 without a ``doc`` have NULL fields; they are the ones a
    reader warns about and skips.
    """
    schema = (
        "path string, doc_no bigint, doc_type int, id_ms bigint, index bigint, "
        "fields array<struct<name:string,value:string>>, error string"
    )
    field = pa.struct([("name", pa.string()), ("value", pa.string())])

    def run(batches):
        for b in batches:
            index, fields, errors = [], [], []
            for body in b.column("body"):
                raw, doc, n, error = body.as_py(), None, None, None
                try:
                    top = wire.top_level(raw, 0, len(raw))
                    kind, start, stop = top.get("doc", (None, 0, 0))
                    if kind == wire.DOCUMENT:
                        doc = [
                            {"name": k, "value": wire.to_json(v)}
                            for k, v in wire.plain_document(raw, start, stop).items()
                        ]
                    kind, start, stop = top.get("index", (None, 0, 0))
                    n = wire.plain_value(raw, kind, start, stop) if kind in (wire.INT32, wire.INT64) else None
                except wire.Malformed as e:
                    error = str(e)
                index.append(n)
                fields.append(doc)
                errors.append(error)
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("path", "doc_no", "doc_type", "id_ms")]
                + [pa.array(index, pa.int64()), pa.array(fields, pa.list_(field)), pa.array(errors, pa.string())],
                names=["path", "doc_no", "doc_type", "id_ms", "index", "fields", "error"],
            )

    meta = docs.filter(F.col("doc_type").isin(METADATA, METADATA_DELTA))
    rows = meta.select("path", "doc_no", "doc_type", "id_ms", "body").mapInArrow(run, schema)
    return apply_mode(rows, mode)
