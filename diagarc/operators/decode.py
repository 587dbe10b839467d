"""Decode: metric documents to keys, change points, samples and series.

A chunk is self-contained, so decoding is one pass over the documents without a
shuffle: the byte stage returns one nested row per chunk and everything after it
is an explode or an array expression on that row. Unchanged values stay collapsed
(``at`` / ``val`` hold change points only) until :func:`samples` or :func:`series`
asks for dense rows. The same steps as operators over ordinary long tables are in
:mod:`diagarc.operators.long_tables`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diagarc.errors import apply_mode
from diagarc.functions.scalar import ms_to_ts
from diagarc.plans.shared import qualified
from diagarc.sources import wire
from diagarc.sources.archives import metric_docs
from diagarc.sources.side_files import put_once

AXIS_NAME = "start"  # fixed value: the series that is the time axis

_HEAD = (
    "path string, doc_no bigint, id_ms bigint, n_keys bigint, n_deltas bigint, n_keys_found bigint, "
    "declared_bytes bigint, inflated_bytes bigint, error string, "
)
CHUNK_ROWS = _HEAD + (
    "axis array<bigint>, keys array<struct<key_no:int,name:string,bson_type:string,base:bigint,"
    "at:array<int>,val:array<bigint>>>"
)
CHUNK_TOKENS = _HEAD + "tokens array<bigint>, reference_doc binary"

_HEAD_FIELDS = [
    ("path", pa.string()), ("doc_no", pa.int64()), ("id_ms", pa.int64()), ("n_keys", pa.int64()),
    ("n_deltas", pa.int64()), ("n_keys_found", pa.int64()), ("declared_bytes", pa.int64()),
    ("inflated_bytes", pa.int64()), ("error", pa.string()),
]
_ERROR_FIELDS = [("path", pa.string()), ("doc_no", pa.int64()), ("error_class", pa.string()), ("error", pa.string())]
_FLUSH_BYTES = 8 << 20


class _Keys:
    """Numpy columns of the keys of several chunks, turned into one nested Arrow array."""

    def __init__(self):
        self.numbers, self.names, self.types, self.bases = [], [], [], []
        self.points, self.at, self.val = [], [], []
        self.per_chunk, self.bytes = [], 0

    def add(self, keep, names, types, bases, points, at, val):
        self.numbers.append(keep)
        self.names += names
        self.types += types
        self.bases.append(bases)
        self.points.append(points)
        self.at.append(at)
        self.val.append(val)
        self.per_chunk.append(len(keep))
        self.bytes += 64 * len(keep) + 12 * len(at)

    def arrow(self):
        def cat(parts, kind):
            return np.concatenate(parts).astype(kind, copy=False) if parts else np.zeros(0, kind)

        def bounds(sizes):
            return pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))

        at = pa.ListArray.from_arrays(bounds(cat(self.points, np.int64)), pa.array(cat(self.at, np.int32)))
        val = pa.ListArray.from_arrays(bounds(cat(self.points, np.int64)), pa.array(cat(self.val, np.int64)))
        fields = pa.StructArray.from_arrays(
            [
                pa.array(cat(self.numbers, np.int32)), pa.array(self.names, pa.string()),
                pa.array(self.types, pa.string()), pa.array(cat(self.bases, np.int64)), at, val,
            ],
            names=["key_no", "name", "bson_type", "base", "at", "val"],
        )
        return pa.ListArray.from_arrays(bounds(self.per_chunk), fields)


_NONE = np.zeros(0, np.int64)


def _running_values(cell, delta, bases, n_deltas):
    """D7 on one chunk: (points per key, sample numbers, values), base first, 64-bit wrapping."""
    key = cell // n_deltas if n_deltas else cell
    points = np.bincount(key, minlength=len(bases)) + 1
    first = np.concatenate(([0], np.cumsum(points)[:-1])).astype(np.int64)
    at = np.zeros(len(cell) + len(bases), np.int64)
    step = np.zeros(len(at), np.int64)
    rest = np.ones(len(at), bool)
    rest[first] = False
    at[rest] = cell % n_deltas + 1 if n_deltas else cell
    step[rest] = delta
    total = np.cumsum(step)
    return points, at, total + np.repeat(bases - total[first], points)


def _put_errors(target, heads):
    """The bad rows among ``heads``, written beside the output of the task."""
    bad = [(path, doc_no, error.split(":", 1)[0], error) for path, doc_no, *_, error in heads if error is not None]
    if bad:
        put_once(target, pa.Table.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*bad), _ERROR_FIELDS)],
                                              names=[n for n, _ in _ERROR_FIELDS]))


def _decode_batches(want, names, spec_bases, validate, errors_to=None):
    wanted = frozenset(names) if names is not None else None

    def chunk(body, keys):
        """Head values and axis of one document; its keys are added to ``keys``."""
        id_ms, declared, inflated, doc, n_keys, n_deltas, tail = wire.open_chunk(body)
        found, types, bases = wire.numeric_keys(doc, spec_bases)
        bases, n_found = np.array(bases, np.int64), len(found)
        if n_deltas >= 2**31 - 1:
            raise wire.Malformed("too_many_samples", str(n_deltas))
        points = at = val = None
        if validate or want != "keys":
            cell, delta = wire.expand_tokens(wire.read_varints(tail), n_found * n_deltas)
        axis_key = max((i for i, name in enumerate(found) if name == AXIS_NAME), default=None)
        if axis_key is None:
            raise wire.Malformed("no_start", "no time axis")
        axis = None
        if want == "values":
            points, at, val = _running_values(cell, delta, bases, n_deltas)
            a, b = (stops := np.cumsum(points))[axis_key] - points[axis_key], stops[axis_key]
            axis = np.repeat(val[a:b], np.diff(np.append(at[a:b], n_deltas + 1)))
        elif want == "deltas":
            key = cell // n_deltas if n_deltas else cell
            points = np.bincount(key, minlength=n_found)
            at, val = (cell % n_deltas + 1 if n_deltas else cell), delta
        keep = np.arange(len(found))
        if wanted is not None:
            keep = np.array([i for i, name in enumerate(found) if name in wanted], np.int64)
            if points is not None:
                cells = np.repeat(np.isin(np.arange(n_found), keep), points)
                points, at, val = points[keep], at[cells], val[cells]
            found, types, bases = [found[i] for i in keep], [types[i] for i in keep], bases[keep]
        if points is None:
            points, at, val = np.zeros(len(keep), np.int64), _NONE, _NONE
        keys.add(keep, found, types, bases, points, at, val)
        return (id_ms, n_keys, n_deltas, n_found, declared, inflated, None), axis

    def flush(heads, axes, keys):
        if errors_to is not None:
            _put_errors(errors_to, heads)
        cols = [pa.array(c, t) for c, (_, t) in zip(zip(*heads), _HEAD_FIELDS)]
        cols += [pa.array(axes, pa.list_(pa.int64())), keys.arrow()]
        return pa.RecordBatch.from_arrays(cols, names=[f[0] for f in _HEAD_FIELDS] + ["axis", "keys"])

    def run(batches):
        for b in batches:
            heads, axes, keys = [], [], _Keys()
            for i in range(b.num_rows):
                path, doc_no = b.column("path")[i].as_py(), b.column("doc_no")[i].as_py()
                error, axis, rest = b.column("error")[i].as_py(), None, (None,) * 6
                if error is None:
                    try:
                        (*rest, error), axis = chunk(b.column("body")[i].as_py(), keys)
                    except wire.Malformed as e:
                        error = str(e)
                if error is not None:
                    keys.add(_NONE, [], [], _NONE, _NONE, _NONE, _NONE)
                heads.append((path, doc_no, *rest, error))
                axes.append(axis)
                if keys.bytes + 8 * sum(len(a) for a in axes if a is not None) > _FLUSH_BYTES:
                    yield flush(heads, axes, keys)
                    heads, axes, keys = [], [], _Keys()
            if heads:
                yield flush(heads, axes, keys)

    return run


def _docs_with_body(docs: DataFrame) -> DataFrame:
    if "doc_type" in docs.columns:
        docs = metric_docs(docs)
    if "error" not in docs.columns:
        docs = docs.withColumn("error", F.lit(None).cast("string"))
    return docs.select("path", "doc_no", "body", "error")


def decode_chunks(docs: DataFrame, want="values", names=None, spec_bases=False, validate=True, mode="failfast",
                  errors_to: str | None = None):
    """One nested row per metric document.

    ``docs`` is any table with ``path``, ``doc_no`` and ``body``. ``want`` limits what
    leaves the byte stage, since Catalyst cannot prune it: ``"keys"`` (no points),
    ``"deltas"`` (changes as stored) or ``"values"`` (changes as running values,
    and the time axis). ``names`` keeps only those metrics. With ``validate`` the
    token stream is checked even where only keys are wanted. ``errors_to`` is a folder in which the
    tasks list bad rows (path, doc_no, error_class, error) as they meet them, each once however often a task
    runs; what a failed job listed stays.
    """
    if want not in ("keys", "deltas", "values"):
        raise ValueError(f"want: {want!r}")
    target = None if errors_to is None else qualified(docs.sparkSession, errors_to)
    run = _decode_batches(want, list(names) if names is not None else None, spec_bases, validate, target)
    return apply_mode(_docs_with_body(docs).mapInArrow(run, CHUNK_ROWS), mode)


def chunk_tokens(docs: DataFrame, mode="failfast") -> DataFrame:
    """S4/S5 variant ``chunks``: raw tokens and reference document of each chunk."""

    def run(batches):
        for b in batches:
            heads, tokens, refs = [], [], []
            for path, doc_no, body, error in zip(*(b.column(c) for c in ("path", "doc_no", "body", "error"))):
                rest, token, doc, error = (None,) * 6, None, None, error.as_py()
                if error is None:
                    try:
                        id_ms, declared, inflated, doc, n_keys, n_deltas, tail = wire.open_chunk(body.as_py())
                        found = len(wire.numeric_keys(doc)[0])
                        token = wire.read_varints(tail).view(np.int64)
                        rest = (id_ms, n_keys, n_deltas, found, declared, inflated)
                    except wire.Malformed as e:
                        error = str(e)
                heads.append((path.as_py(), doc_no.as_py(), *rest, error))
                tokens.append(token)
                refs.append(doc)
            if heads:
                cols = [pa.array(c, t) for c, (_, t) in zip(zip(*heads), _HEAD_FIELDS)]
                cols += [pa.array(tokens, pa.list_(pa.int64())), pa.array(refs, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=[f[0] for f in _HEAD_FIELDS] + ["tokens", "reference_doc"])

    return apply_mode(_docs_with_body(docs).mapInArrow(run, CHUNK_TOKENS), mode)


def chunk_keys(docs: DataFrame, with_points=True, **options) -> DataFrame:
    """Table ``chunk_keys``: one row per key with its stored change points."""
    chunks = decode_chunks(docs, want="deltas" if with_points else "keys", **options)
    k = F.col("k")
    points = F.arrays_zip(k["at"].alias("sample_no"), k["val"].alias("delta"))
    return chunks.select("path", "doc_no", "id_ms", "n_keys", "n_deltas", "error", F.explode_outer("keys").alias("k")).select(
        "path", "doc_no", "id_ms", "n_keys", "n_deltas",
        k["key_no"].alias("key_no"), k["name"].alias("name"), k["bson_type"].alias("bson_type"),
        k["base"].alias("base"), *([points.alias("points")] if with_points else []), "error",
    )


def change_points(keys: DataFrame) -> DataFrame:
    """Table ``change_pts``: the base of each key at sample 0, then its stored deltas."""
    base = F.struct(F.lit(0).alias("sample_no"), F.col("base").alias("delta"))
    rows = keys.filter("key_no is not null").select(
        "path", "doc_no", "key_no", "name", "n_deltas", F.explode(F.concat(F.array(base), "points")).alias("p")
    )
    return rows.select("path", "doc_no", "key_no", "name", "n_deltas", "p.sample_no", "p.delta")


def decoded(chunks: DataFrame) -> DataFrame:
    """``chunks`` as they are, if decoded for values: a chunk that has neither axis nor error is an error here."""
    ok = F.col("axis").isNotNull() | F.col("error").isNotNull()
    message = F.lit("these chunks were decoded without values: use want='values'")
    return chunks.filter(F.when(ok, True).otherwise(F.raise_error(message).cast("boolean")))


def _keys_of(chunks: DataFrame) -> DataFrame:
    k = F.col("k")
    return decoded(chunks).select("path", "doc_no", "n_deltas", "axis", F.explode("keys").alias("k")).select(
        "path", "doc_no", "n_deltas", "axis", k["key_no"].alias("key_no"), k["name"].alias("name"),
        k["at"].alias("at"), k["val"].alias("val"),
    )


def value_changes(chunks: DataFrame) -> DataFrame:
    """Sparse samples: one row per change of value, with the samples it stays in force.

    Last values, extremes, counts of changes and time-weighted means need no more.
    """
    rows = _keys_of(chunks).select("*", F.posexplode("at").alias("i", "sample_no"))
    stop = F.coalesce(F.get("at", F.col("i") + 1), F.col("n_deltas").cast("int") + 1)
    return rows.select(
        "path", "doc_no", "key_no", "name", "sample_no", (stop - F.col("sample_no")).alias("n_samples"),
        F.get("axis", F.col("sample_no")).alias("ts_ms"), F.get("val", F.col("i")).alias("value"),
    )


def samples(chunks: DataFrame, with_ts=True) -> DataFrame:
    """Dense long table of ``decode_chunks`` rows, no shuffle."""
    runs = _keys_of(chunks).select("*", F.posexplode("at").alias("i", "lo"))
    stop = F.coalesce(F.get("at", F.col("i") + 1), F.col("n_deltas").cast("int") + 1)
    rows = runs.select(
        "path", "doc_no", "key_no", "name", "axis", F.get("val", F.col("i")).alias("value"),
        F.explode(F.sequence("lo", stop - 1)).alias("sample_no"),
    )
    rows = rows.select("path", "doc_no", "key_no", "name", "sample_no", F.get("axis", F.col("sample_no")).alias("ts_ms"), "value")
    if with_ts:
        rows = rows.withColumn("ts", ms_to_ts(F.col("ts_ms")))
    return rows


def series(chunks: DataFrame) -> DataFrame:
    """One row per metric and chunk with dense values and the shared axis, no shuffle."""
    stops = F.concat(F.slice("at", 2, F.size("at")), F.array(F.col("n_deltas").cast("int") + 1))
    runs = F.zip_with("at", stops, lambda a, b: b - a)
    dense = F.flatten(F.zip_with("val", runs, lambda v, n: F.array_repeat(v, n)))
    return _keys_of(chunks).select("path", "doc_no", "key_no", "name", dense.alias("values"), F.col("axis").alias("ts_ms"))
