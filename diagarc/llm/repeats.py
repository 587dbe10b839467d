"""Removing repeated passages: every byte that a window of ``width`` bytes covers that also starts elsewhere.

This is a depth-limited radix sort of the text's suffixes, most significant digits first: suffixes
are ordered only through ``width`` bytes, groups that have one member leave after each pass, and
groups that are still together at the end are exactly the repeated windows. Two things keep a
pass small.

The first digit of a window is not its head but its anchor, the run of ``ANCHOR`` bytes with the
smallest hash in it. Equal windows have equal anchors at equal places, and neighbouring windows
share theirs, so one row (an anchor with the range of windows that have it) stands for some 170
windows. A group of anchors of which only one exists holds no repeated window.

Windows of one anchor also travel together: a row covers a range of places of the anchor within
the window. Rows whose whole span of bytes is equal are settled at once. A group with several
different spans is split into blocks of 64, then 8, then single places, each pass comparing the
bytes common to the windows of a block, which are longer each time. Only one representative of
equal rows goes on, so a passage with a hundred thousand copies costs what its different
surroundings cost.

Texts are compared by two 64-bit hashes of different parts of the window, together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diagarc.llm.common import map_batches, staged, table
from diagarc.llm.sketches import _mixed, powers

WIDTH = 400
ANCHOR = 64
BLOCKS = (64, 8, 1)
_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64))
_NODE = "d bigint, th bigint, pos bigint, a int, b int, core bigint, span bigint"
_NAMES = [c.split()[0] for c in _NODE.split(", ")]
_ROW = ["d", "th", "pos", "a", "b"]


def _sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return sums, down


def _parts(sums, down, begin, end, salt) -> np.ndarray:
    """Hashes of the bytes from ``begin`` to ``end``, made different by ``salt``."""
    return _mixed((sums[end] - sums[begin]) * down[begin] ^ _mixed(salt.astype(np.uint64)))


def anchors(data: np.ndarray, width: int = WIDTH, anchor: int = ANCHOR):
    """Of one text: places of anchors, the first and end place within their windows, hashes of anchor and whole span.

    Ties between equal runs go to the leftmost, so the choice depends on the window alone.
    """
    n, reach = len(data), width - anchor + 1
    if n < width:
        return None
    sums, down = _sums(data)
    runs = np.arange(n - anchor + 1)
    hashes = _parts(sums, down, runs, runs + anchor, np.zeros(1))
    value = (hashes & np.uint64(0xFFFFFFFF00000000)) | runs.astype(np.uint64)
    tiles = np.full(-(-len(value) // reach) * reach, np.uint64(2**64 - 1))
    tiles[: len(value)] = value
    tiles = tiles.reshape(-1, reach)
    before = np.minimum.accumulate(tiles, 1).ravel()
    after = np.minimum.accumulate(tiles[:, ::-1], 1)[:, ::-1].ravel()
    windows = n - width + 1
    best = (np.minimum(after[:windows], before[reach - 1 : reach - 1 + windows]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(best)) + 1])
    last = np.append(first[1:], windows) - 1
    pos = best[first]
    a, b = pos - last, pos - first + 1
    return pos, a, b, hashes[pos], _parts(sums, down, first, last + width, a * width + b)


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts with a key of id and text; repeated rows share theirs."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("d"), F.xxhash64(text).alias("th"), text.alias("text"))


def _anchor_rows(docs: DataFrame, width: int, anchor: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        owner, found = [], []
        for i, text in enumerate(batch.column(2)):
            got = anchors(np.frombuffer(text.as_buffer(), np.uint8), width, anchor)
            if got is not None:
                owner.append(np.full(len(got[0]), i))
                found.append(got)
        if not found:
            return None
        owner = pa.array(np.concatenate(owner))
        pos, a, b, core, span = (np.concatenate(c) for c in zip(*found))
        columns = [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(pos), pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                   pa.array(core.view(np.int64)), pa.array(span.view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, _NAMES)

    return map_batches(_keyed(docs), run, _NODE)


def _classes(rows: DataFrame) -> DataFrame:
    """Equal rows as one: core, span, a representative, whether there are others, and whether the core has other spans.

    Classes that are alone with their core are left out: nothing in them is repeated.
    """
    place = F.struct("d", "th", "pos")
    each = rows.groupBy("core", "span").agg(F.min(F.struct(*_ROW)).alias("one"), F.count(F.lit(1)).alias("n"), F.max(place).alias("last"))
    shared = each.groupBy("core").agg(F.count(F.lit(1)).alias("spans")).filter("spans > 1")
    return each.join(shared, "core", "left").filter("n > 1 or spans is not null").withColumn("open", F.col("spans").isNotNull()).drop("spans")


def _contexts(docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """Representatives of open classes with the bytes that their windows cover."""
    wanted = classes.filter("open").select("one.*").groupBy("d", "th").agg(F.collect_list(F.struct("pos", "a", "b")).alias("rows"))
    texts = _keyed(docs).join(wanted, ["d", "th"])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, found = [], []
        for i, (text, rows) in enumerate(zip(batch.column(2), batch.column(3))):
            data = text.as_buffer()
            for r in rows.as_py():
                owner.append(i)
                found.append((r["pos"], r["a"], r["b"], data[r["pos"] - r["b"] + 1 : r["pos"] - r["a"] + width].to_pybytes()))
        owner = pa.array(owner, pa.int64())
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
        columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)]
        return pa.RecordBatch.from_arrays([batch.column(0).take(owner), batch.column(1).take(owner), *columns], [*_ROW, "data"])

    # A batch of texts unfolds to less than twice its size here.
    return map_batches(texts.select("d", "th", "text", "rows"), run, "d bigint, th bigint, pos bigint, a int, b int, data binary")


def _blocks(contexts: DataFrame, size: int, width: int) -> DataFrame:
    """Rows (place range lo to hi of a context) cut into aligned blocks of ``size`` places, with their hashes."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        d, th, pos, a, b, lo, hi, data = batch.columns
        pos, a, b, lo, hi = (c.to_numpy() for c in (pos, a, b, lo, hi))
        sizes = b.astype(np.int64) - a + width - 1
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        sums, down = _sums(np.frombuffer(b"".join(data.to_pylist()), np.uint8))
        block = lo.astype(np.int64) // size
        n = (hi - 1) // size - block + 1
        row = np.repeat(np.arange(len(n)), n)
        block = block[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        low, high = np.maximum(lo[row], block * size), np.minimum(hi[row], (block + 1) * size)
        zero = begins[row] + b[row] - 1  # where the anchor is in the joined bytes
        # Bytes that every window of the block has, wherever this row's own range ends.
        core = _parts(sums, down, zero - block * size, zero - (block + 1) * size + 1 + width, block * width + size)
        span = _parts(sums, down, zero - high + 1, zero - low + width, low * width + high)
        row = pa.array(row)
        columns = [d.take(row), th.take(row), pa.array(pos).take(row), pa.array(low, pa.int32()), pa.array(high, pa.int32()),
                   pa.array(core.view(np.int64)), pa.array(span.view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, _NAMES)

    return map_batches(contexts.select("d", "th", "pos", "a", "b", "lo", "hi", "data"), run, _NODE)


def _repeated(rows: DataFrame, classes: DataFrame, several, width: int) -> DataFrame:
    """Byte ranges (d, th, begin, end) of rows whose whole span occurs elsewhere."""
    again = classes.filter(several).select("core", "span")
    return rows.join(again, ["core", "span"]).select(
        "d", "th", (F.col("pos") - F.col("b") + 1).alias("begin"), (F.col("pos") - F.col("a") + width).alias("end"))


def repeated_ranges(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR) -> DataFrame:
    """(d, th, begin, end): byte ranges, possibly overlapping, that together are all repeated windows."""
    rows = staged(_anchor_rows(docs, width, anchor), "anchors")
    classes = staged(_classes(rows), "classes")
    found = [_repeated(rows, classes, F.col("n") > 1, width)]
    contexts = staged(_contexts(docs, classes, width), "contexts")
    pending = contexts.select("*", F.col("a").alias("lo"), F.col("b").alias("hi"))
    for size in BLOCKS:
        rows = staged(_blocks(pending, size, width), "blocks")
        classes = staged(_classes(rows), "classes")
        # Rows of repeated input rows come twice; only another place is another window.
        found.append(_repeated(rows, classes, F.struct("one.d", "one.th", "one.pos") != F.col("last"), width))
        if size > 1:
            opened = classes.filter("open").select("one.d", "one.th", "one.pos", F.col("one.a").alias("lo"), F.col("one.b").alias("hi"))
            pending = contexts.join(opened, ["d", "th", "pos"]).filter("lo >= a and hi <= b")
    ranges = found[0]
    for more in found[1:]:
        ranges = ranges.unionByName(more)
    return ranges


def without_repeats(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_bytes, removed (array of begin, end: maximal runs), kept (binary) of every row.

    Texts are UTF-8 bytes, null is empty, matches never cross rows. All repeats are judged on the
    input: of equal passages none is kept. Repeated rows repeat each other. Other columns are
    ignored; texts shorter than ``width`` are kept whole.
    """
    marks = repeated_ranges(docs, width, anchor).groupBy("d", "th").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    rows = _keyed(docs.select("doc_id", "text")).select("*", F.when(F.col("d") != -(2**63), F.col("d")).alias("doc_id"))
    joined = rows.join(marks, ["d", "th"], "left").select("doc_id", "text", "ranges")
    struct = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, removed, kept = [], [], []
        for text, ranges in zip(batch.column(1), batch.column(2)):
            data = text.as_py().encode()
            merged: list[list[int]] = []
            for begin, end in sorted((r["begin"], r["end"]) for r in ranges.as_py() or ()):
                if merged and begin <= merged[-1][1]:
                    merged[-1][1] = max(end, merged[-1][1])
                else:
                    merged.append([begin, end])
            at, parts = 0, []
            for begin, end in merged:
                parts.append(data[at:begin])
                at = end
            parts.append(data[at:])
            sizes.append(len(data))
            removed.append([{"begin": x, "end": y} for x, y in merged])
            kept.append(b"".join(parts))
        columns = [pa.array(sizes, pa.int64()), pa.array(removed, struct), pa.array(kept, pa.binary())]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_bytes", "removed", "kept"])

    return map_batches(joined, run, "doc_id bigint, n_bytes bigint, removed array<struct<begin:bigint,end:bigint>>, kept binary")


SQL = f"""
with t as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as (select doc_id, i, md5(substr(h, 2 * i + 1, {2 * WIDTH})) as k from (
  select doc_id, h, unnest(range(length(h) // 2 - {WIDTH - 1})) as i from t where length(h) >= {2 * WIDTH})),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by k) as c from w) where c > 1),
m as (select *, sum(new) over (partition by doc_id order by i) as g from (
  select *, (i - coalesce(lag(i) over (partition by doc_id order by i), -{WIDTH} - 1) > {WIDTH})::int as new from r)),
s as (select doc_id, min(i) as a, max(i) + {WIDTH} as b from m group by doc_id, g),
p as (select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) as x, a as y from s
  union all select t.doc_id, coalesce(max(b), 0), length(any_value(h)) // 2 from t left join s on s.doc_id = t.doc_id group by t.doc_id),
k as (select p.doc_id, string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' order by x) as kept from p join t on t.doc_id = p.doc_id group by p.doc_id),
n as (select doc_id, count(*) as spans from s group by doc_id)
select t.doc_id, (length(h) // 2)::bigint as n_bytes, ((length(h) - length(kept)) // 2)::bigint as n_removed,
  coalesce(spans, 0)::bigint as n_spans, sha256(unhex(kept)) as kept_sha256, coalesce(spans, 0) > 0 as has_repeat
from t join k on k.doc_id = t.doc_id left join n on n.doc_id = t.doc_id"""


def op8_remove_repeats(spark, directory):
    kept = without_repeats(table(spark, directory, "documents"))
    return kept.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
                       F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), (F.size("removed") > 0).alias("has_repeat"))
