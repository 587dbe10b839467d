"""E5: write archives, from per-sample rows to chunk documents to rotated files."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diagarc.functions.scalar import int_div
from diagarc.plans.shared import qualified
from diagarc.sources import wire

DOCS = "path string, doc_no bigint, doc_type int, id_ms bigint, body binary"
_DOC_NAMES = ["path", "doc_no", "doc_type", "id_ms", "body"]


def by_chunk(rows: DataFrame) -> DataFrame:
    """Hash rows by chunk into as many tasks as the session shuffles into.

    The groupings below use this partitioning as it is. It is explicit so that packing
    and unpacking, which cost far more than the bytes suggest, are not coalesced.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "path", "doc_no")


def collect_chunks(rows: DataFrame) -> DataFrame:
    """One nested row per (path, doc_no): the field layout and a samples-by-fields matrix.

    ``rows`` hold one sample each: ``sample_no`` from 0, ``id_ms``, and ``fields`` as
    :func:`diagarc.operators.flatten.flatten_struct` makes them. Chunks are bounded by
    whoever numbered them. Only values move; the layout travels with the first sample. Absent
    values are left out of the document, and a chunk whose samples differ in layout is an
    error: ``chunk_boundaries`` begins a new chunk there. A column ``layout_id`` that is equal just for
    samples of the same layout is taken as it is; without one the names and types are hashed.
    """
    present = F.filter("fields", lambda f: f["value"].isNotNull())
    layout = F.transform(present, lambda f: F.struct(f["field"].alias("field"), f["bson_type"].alias("bson_type")))
    thin = rows.select(
        "path", "doc_no", "id_ms", F.struct("sample_no", F.transform(present, lambda f: f["value"]).alias("v")).alias("s"),
        F.when(F.col("sample_no") == 0, layout).alias("layout"), (F.col("layout_id") if "layout_id" in rows.columns else layout_id("fields")).alias("layout_id"),
    )
    grouped = by_chunk(thin).groupBy("path", "doc_no").agg(
        F.array_sort(F.collect_list("s")).alias("s"), F.first("layout", ignorenulls=True).alias("layout"),
        F.min("id_ms").alias("id_ms"), F.min("layout_id").alias("lo"), F.max("layout_id").alias("hi"),
    )
    message = F.concat_ws(" ", F.lit("samples of different layout in chunk"), "path", F.col("doc_no").cast("string"))
    same = F.when(F.col("lo") == F.col("hi"), F.col("id_ms")).otherwise(F.raise_error(message).cast("bigint"))
    return grouped.select("path", "doc_no", same.alias("id_ms"), "layout", F.transform("s", lambda s: s["v"]).alias("samples"))


def layout_id(fields) -> F.Column:
    """Hash of the names and types of the fields that have a value."""
    present = F.filter(fields, lambda f: f["value"].isNotNull())
    return F.xxhash64(F.transform(present, lambda f: F.struct(f["field"].alias("field"), f["bson_type"].alias("bson_type"))))


def pack_chunks(chunks: DataFrame) -> DataFrame:
    """Metric documents of nested chunk rows; one chunk is packed at a time.

    Values come as ``samples`` (one array per sample) or ``series`` (one per field). A missing
    value, or arrays whose lengths do not fit the layout, are an error.
    """
    by_series = "series" in chunks.columns
    values_column = "series" if by_series else "samples"

    def run(batches):
        for b in batches:
            layouts, nested = b.column("layout"), b.column(values_column)
            ids, bodies = b.column("id_ms").to_pylist(), []
            for i in range(b.num_rows):
                layout = [(f["field"], f["bson_type"]) for f in layouts[i].as_py()]
                arrays = nested[i].values
                sizes, values = np.diff(arrays.offsets.to_numpy()), arrays.flatten()
                fits = len(sizes) == len(layout) and len(set(sizes.tolist())) == 1 if by_series else (sizes == len(layout)).all()
                if not fits or values.null_count or arrays.null_count:
                    raise ValueError(f"chunk {b.column('path')[i]} {b.column('doc_no')[i]}: values do not fit the layout")
                matrix = values.to_numpy(zero_copy_only=False).reshape(len(arrays), -1)
                bodies.append(wire.pack_chunk(ids[i], layout, matrix.T if by_series else matrix))
            yield pa.RecordBatch.from_arrays(
                [b.column("path"), b.column("doc_no"), pa.array([1] * b.num_rows, pa.int32()), b.column("id_ms"),
                 pa.array(bodies, pa.binary())],
                names=_DOC_NAMES,
            )

    return chunks.select("path", "doc_no", "id_ms", "layout", values_column).mapInArrow(run, DOCS)


def pack_metadata(docs: DataFrame) -> DataFrame:
    """Metadata documents of rows (path, doc_no, doc_type, id_ms, index, fields)."""

    def run(batches):
        for b in batches:
            rows = b.select(["id_ms", "doc_type", "index", "fields"]).to_pylist()
            bodies = [
                wire.pack_metadata(r["id_ms"], r["doc_type"], r["index"], [(f["name"], f["value"]) for f in r["fields"]])
                for r in rows
            ]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in _DOC_NAMES[:4]] + [pa.array(bodies, pa.binary())], names=_DOC_NAMES
            )

    return docs.select("path", "doc_no", "doc_type", "id_ms", "index", "fields").mapInArrow(run, DOCS)


def _file_stamp(ms: int) -> str:
    return str(np.datetime64(ms, "ms").astype("datetime64[s]")).replace(":", "-")


def write_archives(docs: DataFrame, directory: str, max_docs: int = 100) -> DataFrame:
    """Append-ordered archive files ``<directory>/<path>/metrics.<time>Z-NNNNN``.

    A source's documents rotate to a new file every ``max_docs``, so no task ever
    holds more than one file's share of a source. A file is written under a
    temporary name and moved into place, so a retried task leaves one whole file. A file
    of that name that holds other bytes is never replaced: the write fails. Returns one
    receipt row per file; the write happens when it is evaluated. Local paths and the
    schemes that ``pyarrow.fs.FileSystem.from_uri`` knows work; others raise.
    """
    target = qualified(docs.sparkSession, directory)
    docs = docs.withColumn("file_no", int_div(F.col("doc_no"), max_docs))
    ordered = docs.repartition("path", "file_no").sortWithinPartitions("path", "file_no", "doc_no")
    schema = "path string, file string, n_docs bigint, n_bytes bigint"

    def run(batches):
        import uuid

        from pyarrow import fs

        if target.startswith("file:"):
            store, root = fs.LocalFileSystem(), "/" + target.removeprefix("file:").lstrip("/")
        else:
            store, root = fs.FileSystem.from_uri(target)
        current, out, receipt = None, None, None

        def close():
            out.close()
            tmp, final = receipt["_tmp"], receipt["_final"]
            there = store.get_file_info(final)
            if there.type == fs.FileType.NotFound:
                store.move(tmp, final)
            else:  # an earlier attempt of this task, or somebody else's file
                same = there.size == receipt["n_bytes"]
                if same:
                    with store.open_input_stream(tmp) as a, store.open_input_stream(final) as b:
                        while same and (part := a.read(1 << 20)):
                            same = part == b.read(len(part))
                store.delete_file(tmp)
                if not same:
                    raise FileExistsError(f"{final} exists with other contents")
            done = {k: v for k, v in receipt.items() if not k.startswith("_")}
            return pa.RecordBatch.from_pylist([done], schema=pa.schema(
                [("path", pa.string()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_bytes", pa.int64())]))

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("path", "file_no", "id_ms", "body")]
            for path, file_no, id_ms, body in zip(*cols):
                if (path, file_no) != current:
                    if out is not None:
                        yield close()
                    current = (path, file_no)
                    name = f"metrics.{_file_stamp(id_ms)}Z-{file_no:05d}"
                    store.create_dir(f"{root}/{path}", recursive=True)
                    final, tmp = f"{root}/{path}/{name}", f"{root}/{path}/_tmp-{uuid.uuid4().hex}"
                    receipt = {"path": path, "file": final, "n_docs": 0, "n_bytes": 0, "_tmp": tmp, "_final": final}
                    out = store.open_output_stream(tmp)
                out.write(body)
                receipt["n_docs"] += 1
                receipt["n_bytes"] += len(body)
        if out is not None:
            yield close()

    return ordered.select("path", "file_no", "id_ms", "body").mapInArrow(run, schema)
