"""The trie of conversations by their first turns, from vertical bitmaps.

Conversations are ordered by path and cut into shards of bounded size. A shard indexes every
(position, turn) as the bitset of its conversations that have the turn there. Depth-first, the
bitset of a node is intersected with the postings of the next position: what is left is a child, its
count of bits is the child's size, the members that no child takes end at the node. Each child is
found by the turn of the lowest member not yet taken, so no posting is tried in vain.

Nodes that several shards have are merged by a digest of their path: sizes add up, the smallest
member wins, and ends, which neighbouring shards hold in order, are hashed one block after another.

Sums over subtrees need no steps by depth. A conversation owns the nodes of which it is the smallest
member; these are one run of its path, down to its end. A node's subtree is therefore the rest of
its owner's run and every other run that passes through the node further up: each run is counted
once at each of its upper nodes, and those are at most the turns of its conversation.

Texts never move: a turn is a digest and its number of characters.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import md5, sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from diagarc.llm.common import staged, table
from diagarc.llm.turn_repair import CRC

#: Most conversations and turns of a shard; a longer conversation is a shard of its own.
MEMBERS, TURNS = 4096, 1 << 16
#: Turns by which conversations are ordered; beyond them by id.
ORDERED = 8
#: Conversations of one block share a first part, and this many less one first turns at most.
EVERY, HEADS = 100, 6
ROOT = b"\0" * 16
LOCAL = "shard bigint, node binary, parent binary, depth int, n bigint, conv_id bigint, chars bigint, inner boolean, ends array<bigint>, trail array<binary>"


def paths(conversations: DataFrame) -> DataFrame:
    """conv_id, path: (digest, chars) of every turn by number, nulls first, equal numbers by digest.

    The digest is 16 bytes of sha2 of role and text; null and empty are the same. Rows without
    conv_id take no part; other columns are ignored.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256)
    turn = F.struct(F.col("turn").cast("bigint").alias("turn"), F.unhex(F.substring(said, 1, 32)).alias("digest"), F.length(text).cast("bigint").alias("chars"))
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("turn"))
    path = F.transform(F.sort_array(F.collect_list("turn")), lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars")))
    return rows.groupBy("conv_id").agg(path.alias("path"))


def rebuilt(own: DataFrame) -> DataFrame:
    """conv_id, path: the first crc32(conv_id) % HEADS turns become those of the block's first conversation, if there is one."""
    base = F.col("conv_id") - F.col("conv_id") % EVERY
    donors = own.filter(F.col("conv_id") % EVERY == 0).select(F.col("conv_id").alias("base"), F.slice("path", 1, HEADS - 1).alias("head"))
    heads = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    met = own.withColumn("base", base).withColumn("heads", heads).join(donors, "base", "left")
    first = F.coalesce(F.slice("head", F.lit(1), F.col("heads")), F.array().cast("array<struct<digest:binary,chars:bigint>>"))
    return met.select("conv_id", F.concat(first, F.slice("path", F.col("heads") + 1, F.greatest(F.size("path"), F.lit(1)))).alias("path"))


def shard_nodes(convs: list[int], turns: list[list], chars: list[list]) -> Iterator[tuple]:
    """node, parent, depth, n, conv_id, chars, inner, ends, trail of every node of one shard.

    ``convs`` ascend. ``inner`` says that the node has children. ``trail`` holds the path to a node
    whose smallest member is not that of its parent, else None.
    """
    postings: dict[tuple[int, bytes], int] = {}
    for bit, path in enumerate(turns):
        for at, turn in enumerate(path):
            postings[at, turn] = postings.get((at, turn), 0) | 1 << bit
    trail: list[bytes] = []
    stack = [(0, ROOT, None, (1 << len(convs)) - 1, 0, True)]
    while stack:
        depth, node, parent, members, size, top = stack.pop()
        del trail[depth:]
        lowest = (members & -members).bit_length() - 1
        left, ends, children = members, [], []
        while left:
            one = (left & -left).bit_length() - 1
            path = turns[one]
            if len(path) == depth:
                ends.append(convs[one])
                left ^= 1 << one
                continue
            child = members & postings[depth, path[depth]]
            children.append((depth + 1, md5(node + path[depth]).digest(), node, child, chars[one][depth], one != lowest))
            left &= ~child
        yield node, parent, depth, members.bit_count(), convs[lowest], size, bool(children), ends, list(trail) if top else None
        trail.append(node)
        stack.extend(reversed(children))


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    schema = pa.schema([("shard", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int32()), ("n", pa.int64()), ("conv_id", pa.int64()),
                        ("chars", pa.int64()), ("inner", pa.bool_()), ("ends", pa.list_(pa.int64())), ("trail", pa.list_(pa.binary()))])
    number = TaskContext.get().partitionId() << 32

    def emit(rows: list) -> Iterator[pa.RecordBatch]:
        nonlocal number
        rows.sort(key=lambda r: r[0])
        out = []
        for found in shard_nodes(*map(list, zip(*rows))):
            out.append((number, *found))
            if len(out) == 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        number += 1

    rows, held = [], 0
    for batch in batches:
        for conv_id, turns, chars in zip(*(c.to_pylist() for c in batch.columns[:3])):
            if rows and (len(rows) == MEMBERS or held + len(turns) > TURNS):
                yield from emit(rows)
                rows, held = [], 0
            rows.append((conv_id, turns, chars))
            held += len(turns)
    if rows:
        yield from emit(rows)


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per node from rows in order of node and first end; ends are hashed as they come."""
    columns = ["node", "parent", "depth", "n", "conv_id", "chars", "inner", "shard", "ends_sha256"]
    types = [pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.string()]

    def emit(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], columns)

    done, now, digest, any_end = [], None, None, False
    for batch in batches:
        for node, parent, depth, n, conv_id, chars, inner, shard, ends in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now[0] != node:
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest, any_end = [node, parent, depth, 0, conv_id, chars, False, shard], sha256(), False
            now[3] += n
            now[4], now[6], now[7] = min(now[4], conv_id), now[6] or inner, min(now[7], shard)
            if ends:
                digest.update((b"," if any_end else b"") + ",".join(map(str, ends)).encode())
                any_end = True
        if len(done) >= 8192:
            yield emit(done)
            done = []
    if now is not None:
        done.append((*now, digest.hexdigest()))
    if done:
        yield emit(done)


def trie(convs: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    ``convs`` holds conv_id, unique and not null, and path as ``paths`` returns it, which may be
    empty. No conversations give no nodes, not even a root. The ends of one node are hashed by one
    task, block after block, since the digest is of one long list.
    """
    turns = F.transform("path", lambda t: t["digest"])
    rows = staged(convs.select("conv_id", turns.alias("turns"), F.transform("path", lambda t: t["chars"]).alias("chars")), "paths")
    size = rows.agg(F.count(F.lit(1)), F.sum(F.size("turns"))).first()
    parts = max(int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size[0] // MEMBERS, (size[1] or 0) // TURNS)
    head = F.slice("turns", 1, ORDERED)
    ordered = rows.withColumn("head", head).repartitionByRange(parts, "head", "conv_id").sortWithinPartitions("head", "conv_id")
    local = staged(ordered.select("conv_id", "turns", "chars").mapInArrow(_shards, LOCAL), "nodes")

    blocks = local.select("node", "parent", "depth", "n", "conv_id", "chars", "inner", "shard", "ends")
    blocks = blocks.repartition("node").sortWithinPartitions("node", F.get("ends", F.lit(0)))
    merged = blocks.mapInArrow(_merged, "node binary, parent binary, depth int, n bigint, owner bigint, chars bigint, inner boolean, shard bigint, ends_sha256 string")
    nodes = staged(merged, "merged")

    # Sums along the run that the owner has, from its end up.
    run = W.partitionBy("owner").orderBy(F.desc("depth"))
    sums = nodes.withColumn("saved", F.sum((F.col("n") - 1) * F.col("chars")).over(run)).withColumn("leaves", F.sum(F.when(F.col("inner"), 0).otherwise(1)).over(run))
    sums = staged(sums.drop("chars", "inner"), "sums")
    totals = sums.groupBy("owner").agg(F.min_by("saved", "depth").alias("saved"), F.min_by("leaves", "depth").alias("leaves"))
    # The upper nodes of a run: the path to where its conversation is the smallest of the shard, and nodes it has there but not overall.
    here = local.select("shard", "node", F.col("conv_id").alias("own"), "inner", "trail").join(sums.select("node", "owner"), "node")
    above = local.filter("trail is not null").select(F.col("conv_id").alias("owner"), F.explode("trail").alias("node"))
    above = above.unionByName(here.filter("own <> owner").select(F.col("own").alias("owner"), "node"))
    passing = above.join(totals, "owner").groupBy("node").agg(F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"))
    children = sums.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    # A parent is looked up in the child's shard, so that no parent's children meet in one task.
    parents = here.filter("inner").select("shard", F.col("node").alias("parent"), F.col("owner").alias("parent_conv_id"))
    whole = sums.join(passing, "node", "left").join(children, "node", "left").join(parents, ["shard", "parent"], "left")
    zero = F.lit(0).cast("bigint")
    return whole.select(
        F.col("owner").alias("conv_id"), F.col("depth").cast("bigint").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"),
        F.coalesce("n_children", zero).alias("n_children"), (F.col("leaves") + F.coalesce("more_leaves", zero)).alias("n_leaves"),
        (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved_tokens"), "ends_sha256")


SQL = f"""
with recursive o as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
  row_number() over (partition by conv_id order by turn nulls first, role, text) as i from conversations where conv_id is not null),
c as (select distinct conv_id, conv_id - conv_id % {EVERY} as base, {CRC.format("conv_id::varchar")} % {HEADS} as h from o),
b as (select c.conv_id, row_number() over (partition by c.conv_id order by x.first desc, x.i) as i, x.role, x.text from c join (
  select conv_id, i, role, text, true as first from o union all select conv_id, i, role, text, false from o) x
  on (first and x.conv_id = c.base and x.i <= h) or (not first and x.conv_id = c.conv_id and x.i > h)),
m(conv_id, depth, node, chars) as (select conv_id, 0::bigint, '', 0::bigint from c
  union all select m.conv_id, depth + 1, sha256(node || ':' || length(role) || ':' || role || text), length(text) from m join b on b.conv_id = m.conv_id and b.i = depth + 1),
l as (select conv_id, max(depth) as last from m group by 1),
n as (select node, min(m.conv_id) as conv_id, any_value(depth) as depth, count(*) as n_convs, any_value(chars) as chars,
  sha256(coalesce(string_agg(case when last = depth then m.conv_id::varchar end, ',' order by m.conv_id), '')) as ends_sha256 from m join l on l.conv_id = m.conv_id group by node),
e as (select distinct a.node as parent, z.node from m a join m z on z.conv_id = a.conv_id and z.depth = a.depth + 1),
k as (select parent, count(*) as n_children from e group by 1),
s as (select distinct a.node as above, z.node from m a join m z on z.conv_id = a.conv_id and z.depth >= a.depth),
t as (select above, count(*) filter (k.parent is null) as n_leaves, sum((n_convs - 1) * chars) as saved from s join n on n.node = s.node left join k on k.parent = s.node group by 1)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(k.n_children, 0)::bigint as n_children, t.n_leaves, t.saved::bigint as saved_tokens, n.ends_sha256
from n join t on t.above = n.node left join k on k.parent = n.node left join e on e.node = n.node left join n p on p.node = e.parent"""


def op13_prefix_trie(spark, directory):
    return trie(rebuilt(paths(table(spark, directory, "conversations"))))
