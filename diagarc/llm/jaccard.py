"""Documents whose sets of word shingles are alike, exactly, and the groups that such links make.

Texts with equal sets become one node. Candidates are found without comparing pairs. Sets that reach
the threshold differ in at most D shingles, D by the size band of the smaller one. Cut the range of
hashes into more than D parts, and some part holds just the same shingles of both. So every node
has a key per part, the digest of what it has there. Sets with E parts that are not empty share
E - D keys at least, so a node can do without its E - D - 1 most frequent ones: the rarest key of a
pair that is alike is still one of both. What lines in common make alike by chance is mostly among
these, so nodes that share a key that is left, directly or over others, form a candidate group of
hardly more than sets that are alike, however many documents there are.

Keys move as six bytes each, with two for their node, in blobs by range of keys; only keys of
several nodes leave the task that sorts a range.

Groups are compared in tiles: blocks of nodes of one size band against blocks of the same or the
next band, since sets of more different sizes cannot be alike enough. In a tile, hashed bitmaps
bound the overlap of a pair from above by counting bits that only one of them has; what passes is
intersected exactly, unless the two are connected already. A tile returns links that connect what
is connected, never all pairs. Large groups are first compared within blocks and against a pivot
per band; then only nodes outside the group's largest component meet the other blocks.

Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from diagarc.llm.common import discard, let_go, map_batches, slices, staged, table
from diagarc.llm.components import components
from diagarc.llm.repeats import _sums
from diagarc.llm.sketches import _mixed

SHINGLE = 4
#: Similarity in hundredths.
LEAST = 85
#: Nodes of a group that is one tile; shingles of a block of a larger one, and its least and most nodes.
SMALL, BLOCK, LEAST_BLOCK, MOST_BLOCK = 512, 1 << 19, 64, 2048
_CHARS_AT_ONCE = 1 << 20
#: Bytes of text whose keys are one bucket, sorted by one task; keys that a task holds until they leave in blobs.
BUCKET, _KEYS_AT_ONCE = 1 << 23, 1 << 19
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of runs of ``width`` words; fewer words are one run; none: empty."""
    data = np.frombuffer((text or "").encode().translate(_LOWER), np.uint8)
    word = np.concatenate([[False], ~_SPACE[data], [False]])
    edges = np.flatnonzero(word[1:] != word[:-1])
    begin, end = edges[::2], edges[1::2]
    if not len(begin):
        return np.zeros(0, np.uint64)
    sums, down = _sums(data)
    words = _mixed((sums[end] - sums[begin]) * down[begin])
    n = min(width, len(words))
    runs = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        runs = _mixed(runs * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - n + 1 + i])
    return np.unique(runs)


def band_of(n: int, least: int = LEAST) -> int:
    """Size band: sets that are alike enough lie in the same or in neighbouring bands."""
    return int(math.log(n) / math.log(100 / least) + 1e-9)


def parts_of(band: int, least: int = LEAST) -> tuple[int, int]:
    """D and the number of parts for sets of which the smaller is in ``band``.

    Alike sets of sizes a <= b have at most (100 - least) (a + b) / (100 + least) shingles in one
    of them only, and b <= 100 a / least. Some more than D + 1 parts leave room for empty ones.
    """
    differ = math.floor(math.exp((band + 1) * math.log(100 / least)) * (100 - least) / least + 1e-6)
    return differ, differ + 2 + differ // 6


def part_keys(own: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Keys of a sorted set, of which any set alike enough but not equal has one too."""
    return _part_keys(own, least)[0]


def _part_keys(own: np.ndarray, least: int) -> tuple[np.ndarray, list[int]]:
    """:func:`part_keys`, and how many of the even and of the odd ones the set can do without.

    At most D parts differ, so there is an equal part that is not empty if more than D parts of
    either set are not empty. Sets that have no more than that get keys for empty parts as well,
    which they share with each other. Keys for one band are all even or all odd.
    """
    keys, spare, mixed = [], [0, 0], _mixed(own)
    for band in (band_of(len(own), least) - 1, band_of(len(own), least)):
        differ, parts = parts_of(band, least)
        if not differ:
            continue
        part = (own >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        first = np.append(0, np.flatnonzero(part[1:] != part[:-1]) + 1)
        salt = np.uint64((band + 1) << 40)
        found = [_mixed(np.add.reduceat(mixed, first) ^ _mixed(part[first] + salt))]
        if len(first) <= differ:
            found.append(_mixed(np.setdiff1d(np.arange(parts, dtype=np.uint64), part[first]) + salt + np.uint64(1 << 39)))
        odd = band & 1
        keys += [k & np.uint64(2**48 - 2) | np.uint64(odd) for k in found]
        spare[odd] = max(0, len(first) - differ - 1)
    # Six bytes tell candidates apart well enough.
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64), spare


def _digest(hashes: np.ndarray) -> bytes:
    return blake2b(hashes.tobytes(), digest_size=16).digest()


_KEYED = pa.schema([
    ("d", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("set", pa.binary()), ("sid", pa.int64()), ("even", pa.int64()),
    ("odd", pa.int64()), ("base", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary()), ("at", pa.binary())])


def _key_blobs(base: int, counts: list[int], keys: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """Keys of consecutive nodes from ``base`` on: a row per bucket with six bytes of each key and two of its node less the base."""
    key, at = np.concatenate(keys), np.repeat(np.arange(len(counts), dtype="<u2"), counts)
    bucket = (key % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    key, at, bucket = key[order], at[order], bucket[order]
    begin = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(key) else np.zeros(0, np.int64)
    edges = np.append(begin, len(key))
    six = np.ascontiguousarray(key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
    blobs = [pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer((edges * width).astype(np.int32)), pa.py_buffer(data)])
             for width, data in ((6, six), (2, at))]
    none = [pa.nulls(len(begin), f.type) for f in list(_KEYED)[:7]]
    return pa.RecordBatch.from_arrays([*none, pa.array([base] * len(begin), pa.int64()), pa.array(bucket[begin]), *blobs], schema=_KEYED)


def _sets(docs: DataFrame, width: int, least: int, buckets: int) -> DataFrame:
    """A row per document with its set's size, digest, own number ``sid`` and keys to spare; and rows (base, bucket, keys, at) of :func:`_key_blobs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        sid = TaskContext.get().partitionId() << 33
        base, counts, held, total = sid, [], [], 0
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for begin, end in slices([t or "" for t in texts], _CHARS_AT_ONCE):
                sizes, nodes, spares, bases = [], [], [], []
                for text in texts[begin:end]:
                    if total >= _KEYS_AT_ONCE or len(counts) == 1 << 16:
                        yield _key_blobs(base, counts, held, buckets)
                        base, counts, held, total = sid + len(sizes), [], [], 0
                    own = shingle_set(text, width)
                    keys, spare = _part_keys(own, least) if len(own) else (np.zeros(0, np.uint64), [0, 0])
                    counts.append(len(keys))
                    held.append(keys)
                    total += len(keys)
                    sizes.append(len(own))
                    nodes.append(_digest(own))
                    spares.append(spare)
                    bases.append(base)
                n, some = len(sizes), batch.slice(begin, end - begin)
                even, odd = zip(*spares)
                columns = [some.column(0), some.column(2), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()),
                           pa.array(np.arange(sid, sid + n)), pa.array(even, pa.int64()), pa.array(odd, pa.int64()), pa.array(bases, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.nulls(n, f.type) for f in list(_KEYED)[8:]]], schema=_KEYED)
                sid += n
        if counts:
            yield _key_blobs(base, counts, held, buckets)

    rows = docs.select(F.col("doc_id").alias("d"), "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(run, from_arrow_schema(_KEYED))


def _without_copies(keyed: DataFrame, copies: DataFrame) -> DataFrame:
    """Blobs (base, bucket, keys, at) without the keys of the rows ``copies`` (sid, base), whose set another row has too.

    So a set's keys move once however many rows have it. What every task must know for that is a bit per row at most.
    """

    def bits(group: pa.Table) -> pa.Table:
        gone = np.zeros(1 << 16, bool)
        gone[np.asarray(group["at"])] = True
        return pa.table({"base": group["base"][:1], "gone": pa.array([np.packbits(gone[: gone.nonzero()[0][-1] + 1]).tobytes()], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            keys, places = [], []
            for own, at, gone in zip(*(batch.column(c).to_pylist() for c in ("keys", "at", "gone"))):
                if gone is not None:
                    node = np.frombuffer(at, "<u2")
                    flags = np.unpackbits(np.frombuffer(gone, np.uint8)).astype(bool)
                    keep = (node >= len(flags)) | ~flags[np.minimum(node, len(flags) - 1)]
                    own, at = np.frombuffer(own, np.uint8).reshape(-1, 6)[keep].tobytes(), node[keep].tobytes()
                keys.append(own)
                places.append(at)
            yield pa.RecordBatch.from_arrays([batch.column("base"), batch.column("bucket"), pa.array(keys, pa.binary()), pa.array(places, pa.binary())],
                                             ["base", "bucket", "keys", "at"])

    gone = copies.select("base", (F.col("sid") - F.col("base")).alias("at")).groupBy("base").applyInArrow(bits, "base bigint, gone binary")
    blobs = keyed.filter("bucket is not null").select("base", "bucket", "keys", "at")
    return blobs.join(F.broadcast(gone), "base", "left").mapInArrow(run, "base bigint, bucket bigint, keys binary, at binary")


def _met_keys(blobs: DataFrame) -> DataFrame:
    """(key, sid, times) of the keys that occur several times."""

    def run(group: pa.Table) -> pa.Table:
        at = [np.frombuffer(x, "<u2") for x in group["at"].to_pylist()]
        sid = np.repeat(np.asarray(group["base"]), [len(x) for x in at]) + np.concatenate(at)
        key = np.zeros((len(sid), 8), np.uint8)
        key[:, :6] = np.frombuffer(b"".join(group["keys"].to_pylist()), np.uint8).reshape(-1, 6)
        key = key.view("<i8").ravel()
        order = np.argsort(key, kind="stable")
        key, sid = key[order], sid[order]
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        times = np.diff(np.append(begin, len(key)))
        times = np.repeat(times, times)
        several = times > 1
        return pa.table({"key": key[several], "sid": sid[several], "times": times[several]})

    return blobs.groupBy("bucket").applyInArrow(run, "key bigint, sid bigint, times bigint")


def _needed_keys(met: DataFrame, nodes: DataFrame) -> DataFrame:
    """(set, sid, keys): what nodes have of the keys that occur several times, less the most frequent ones that they can do without.

    Two sets that are alike share more keys than either can spare, so the one of these that comes last by (times, key) is needed by both.
    """
    rows = met.join(nodes.select(F.col("node").alias("sid"), "set", "even", "odd"), "sid").withColumn("is_odd", F.col("key") % 2)
    place = F.row_number().over(W.partitionBy("sid", "is_odd").orderBy(F.desc("times"), "key"))
    rows = rows.withColumn("place", place).filter(F.col("place") > F.when(F.col("is_odd") == 1, F.col("odd")).otherwise(F.col("even")))
    return rows.groupBy("sid").agg(F.any_value("set").alias("set"), F.collect_list("key").alias("keys"))


def _hub_edges(sets: DataFrame) -> DataFrame:
    """Edges (u, v) from nodes to the smallest node with a key of theirs."""
    nodes = sets.groupBy("set").agg(F.min("sid").alias("node"), F.any_value("keys").alias("keys"))
    # Nearly all keys occur once, so a hash table of them or a second sort for a join would hold a task's whole
    # share again; one sort by key brings together who meets, and only edges go on.
    have = nodes.select("node", F.explode("keys").alias("key"))
    met = have.withColumn("v", F.min("node").over(W.partitionBy("key"))).filter("node <> v")
    return met.select(F.col("node").alias("u"), "v").distinct()


def _candidate_groups(sets: DataFrame) -> DataFrame:
    """(node, label) of nodes that share a key, directly or over others."""
    return components(staged(_hub_edges(sets), "hubs"))


def _linked(sets: list[np.ndarray], start: list, left: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Links among the sets of one tile that connect what is connected: positions of pairs.

    ``start`` gives what is connected already; only pairs with at least one of ``left`` are compared.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    bits = 1 << max(6, min(12, int(sizes.max(initial=1)).bit_length() + 1))
    maps = np.zeros((len(sets), bits), bool)
    for i, s in enumerate(sets):
        maps[i, (s & np.uint64(bits - 1)).astype(np.int64)] = True
    maps = np.packbits(maps, axis=1).view(np.uint64)
    first: dict = {}
    label = np.array([first.setdefault(k, i) for i, k in enumerate(start)])
    links = []
    order = np.argsort(sizes, kind="stable")
    small = sizes[order]
    for at, i in enumerate(order):
        stop = np.searchsorted(small, 100 * sizes[i] // least, side="right")
        others = order[at + 1 : stop]
        others = others[(label[others] != label[i]) & (left[others] | left[i])]
        if not len(others) or not sizes[i]:
            continue
        need = -(-least * (sizes[i] + sizes[others]) // (100 + least))
        mine = sizes[i] - np.bitwise_count(maps[i] & ~maps[others]).sum(1, dtype=np.int64)
        theirs = sizes[others] - np.bitwise_count(maps[others] & ~maps[i]).sum(1, dtype=np.int64)
        for j, least_overlap in zip(others[np.minimum(mine, theirs) >= need], need[np.minimum(mine, theirs) >= need]):
            if label[j] == label[i]:
                continue
            place = np.searchsorted(sets[j], sets[i])
            place[place == len(sets[j])] = 0
            if int((sets[j][place] == sets[i]).sum()) >= least_overlap:
                links.append((int(i), int(j)))
                label[label == label[j]] = label[i]
    return links


def _tile_links(rows: DataFrame, width: int, least: int) -> DataFrame:
    """Links (u, v) found in every tile of rows (tile, node, text, label, is_left)."""

    def run(group: pa.Table) -> pa.Table:
        # A node that is on both sides of a tile counts as left.
        group = group.take(np.argsort(~np.asarray(group["is_left"]), kind="stable"))
        _, first = np.unique(np.asarray(group["node"]), return_index=True)
        group = group.take(first)
        nodes = group["node"].to_pylist()
        sets = [shingle_set(t, width) for t in group["text"].to_pylist()]
        links = _linked(sets, group["label"].to_pylist(), np.array(group["is_left"].to_pylist(), bool), least)
        return pa.table({"u": pa.array([nodes[i] for i, _ in links], pa.int64()), "v": pa.array([nodes[j] for _, j in links], pa.int64())})

    return rows.select("tile", "node", "text", "label", "is_left").groupBy("tile").applyInArrow(run, "u bigint, v bigint")


def _tiles(texts: DataFrame, width: int, least: int) -> tuple[DataFrame, list[DataFrame]]:
    """Links among candidates (node, n, grp, text), and the tables staged for them."""
    step = math.log(100 / least)
    rows = texts.withColumn("band", F.floor(F.log("n") / step + 1e-9).cast("int"))
    sizes = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("members"))
    rows = rows.join(sizes, "grp")
    true, own = F.lit(True), F.col("node").alias("label")
    small = rows.filter(F.col("members") <= SMALL).select(F.struct("grp").alias("tile"), "node", "text", own, true.alias("is_left"))
    found = [_tile_links(small, width, least)]

    large = staged(rows.filter(F.col("members") > SMALL).drop("members"), "large")
    # The sizes of a band lie within a few hundredths, so its blocks hold about the same number of shingles.
    each = F.greatest(F.lit(LEAST_BLOCK), F.least(F.lit(MOST_BLOCK), F.lit(BLOCK) / F.exp(F.col("band") * step)))
    counts = large.groupBy("grp", "band").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("pivot"))
    counts = counts.select("grp", "band", F.ceil(F.col("members") / each).cast("int").alias("blocks"), "pivot")
    counts = staged(counts, "bands")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = large.join(counts.drop("pivot"), ["grp", "band"]).withColumn("block", block)
    # Within blocks, and against the pivots of the neighbouring bands.
    near = F.explode(F.array(F.col("band") - 1, "band", F.col("band") + 1))
    pivots = large.join(counts.select("grp", F.col("pivot").alias("node")), ["grp", "node"], "left_semi").select("grp", near.alias("band"), "node", "text")
    pivots = pivots.join(counts.select("grp", "band", "blocks"), ["grp", "band"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    columns = ["grp", "band", "block", "node", "text"]
    inner = placed.select(*columns).unionByName(pivots.select(*columns))
    inner = inner.select(F.struct("grp", "band", "block").alias("tile"), "node", "text", own, true.alias("is_left"))
    links = staged(_tile_links(inner, width, least), "links")
    found.append(links)

    # Nodes outside their group's largest component so far, against everything in the bands around.
    labels = components(links)
    marked = large.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    marked = staged(marked, "marked")
    main = marked.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("size"))
    main = main.groupBy("grp").agg(F.max_by("label", F.struct("size", "label")).alias("main"))
    rest = staged(marked.join(main, "grp").filter("label <> main").drop("main"), "rest")
    parts = rest.groupBy("grp", "band").agg(F.count(F.lit(1)).alias("members"))
    parts = parts.select("grp", "band", F.ceil(F.col("members") / each).cast("int").alias("parts"))
    parts = staged(parts, "parts")
    left = rest.join(parts, ["grp", "band"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    left = left.select("grp", F.col("band").alias("home"), near.alias("band"), "part", "node", "text", "label")
    left = left.join(counts.select("grp", "band", "blocks"), ["grp", "band"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = marked.join(counts.select("grp", "band", "blocks"), ["grp", "band"]).withColumn("block", block)
    right = right.withColumn("home", near).join(parts.withColumnRenamed("band", "home"), ["grp", "home"])
    right = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tile = F.struct("grp", "home", "part", "band", "block").alias("tile")
    outer = left.select(tile, "node", "text", "label", true.alias("is_left")).unionByName(
        right.select(tile, "node", "text", "label", F.lit(False).alias("is_left")))
    found.append(_tile_links(outer, width, least))
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links, [large, counts, found[1], marked, rest, parts]


def alike_groups(docs: DataFrame, width: int = SHINGLE, least: int = LEAST) -> DataFrame:
    """doc_id, n_shingles, component_id, component, text_hash of every row.

    ``component_id`` is the smallest id that links reach, the row's own included; ``component`` tells
    groups apart where ids repeat, and is null without words; ``text_hash`` is ``xxhash64(text)``. Rows without words are linked with nothing. Null ids take part: their group
    has the smallest other id, or null. Rows that repeat an id are rows of their own; other
    columns are ignored.
    """
    size = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET))
    # The numbers of the rows are written with them: later reads may be split otherwise.
    keyed = staged(_sets(docs, width, least, buckets), "keyed")
    sets = staged(keyed.filter("bucket is null").select("d", "text_hash", "n", "set", "sid", "even", "odd", "base"), "sets")
    filled = sets.filter("n > 0")
    spare = [F.any_value(c).alias(c) for c in ("even", "odd")]
    nodes = staged(filled.groupBy("set").agg(F.min("sid").alias("node"), F.min("d").alias("least"), *spare), "nodes")
    copies = filled.join(nodes.select("set", "node"), "set").filter("sid <> node")
    met = staged(_met_keys(_without_copies(keyed, copies)), "met")
    discard(keyed)
    groups = _candidate_groups(_needed_keys(met, nodes))
    discard(met)
    # By way of the staged row: its id and set lead back to its text.
    homes = filled.select(F.col("sid").alias("node"), "d", "n", "set")
    wanted = groups.withColumnRenamed("label", "grp").join(homes, "node")
    met = docs.select(F.col("doc_id").alias("own"), "text").join(wanted, F.col("own").eqNullSafe(F.col("d"))).select("node", "n", "grp", "set", "text")

    def same(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = [_digest(shingle_set(t, width)) == s for t, s in zip(batch.column(4).to_pylist(), batch.column(3).to_pylist())]
        return batch.filter(pa.array(keep, pa.bool_()))

    texts = map_batches(met, same, "node bigint, n bigint, grp bigint, set binary, text string").drop("set")
    texts = staged(texts, "texts")
    links, tables = _tiles(texts, width, least)
    labels = components(links).withColumnRenamed("label", "component")
    discard(texts, *tables)
    named = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = staged(named, "named")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_set = named.join(smallest, "component").select("set", "component_id", "component")
    names = F.col("d").alias("doc_id"), F.col("n").alias("n_shingles")
    own = filled.select("d", "n", "set", "text_hash").join(by_set, "set").select(*names, "component_id", "component", "text_hash")
    empty = sets.filter("n = 0").select(*names, F.col("d").alias("component_id"), F.lit(None).cast("bigint").alias("component"), "text_hash")
    return own.unionByName(empty)


SQL = f"""
with recursive t as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i : i + {SHINGLE - 1}], ' ') as shingle from (
  select doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) as i from t where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as a, b.doc_id as b, count(*) as o from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2),
l as (select c.a, c.b from c join n x on x.doc_id = c.a join n y on y.doc_id = c.b where 100 * o >= {LEAST} * (x.n + y.n - o)),
e as (select a, b from l union all select b, a from l),
r as (select a as doc_id, a as seen from e union select r.doc_id, e.b from r join e on e.a = r.seen)
select t.doc_id, coalesce(any_value(n.n), 0)::bigint as n_shingles, least(t.doc_id, min(r.seen)) as component_id
from t left join n on n.doc_id = t.doc_id left join r on r.doc_id = t.doc_id group by t.doc_id"""


def op9_jaccard_join(spark, directory):
    return alike_groups(table(spark, directory, "documents")).drop("component", "text_hash")
