"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are put into a fixed random order and laid end to end as one stream of
words, cut into blocks of ``block`` words. A golden-ratio sequence of points in [0, 1) is mapped
through the sources' cumulative weights: point i says which source supplies slot i, and the
slot's rank among its source's slots says which block it takes. Every prefix of the slots is
therefore close to the target weights. A document's words are taken where a slot takes their
block. A source's last block is cut at its target; a source
whose target is above its size runs through its stream again.

Only DataFrame functions are used. Sums and ranks within a source are two-level, so a source
that holds most rows is still dealt over many tasks; what is gathered per source is one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from diagarc.llm.common import buckets_of, running_before, staged, table

#: Words are separated by these characters only.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BLOCK = 256
#: Points are multiples of 1 / GRID. Step and grid are neighbouring Fibonacci numbers (45th, 46th), so
#: their ratio has the gaps of the golden ratio at every number of points up to a whole period.
GRID = 1836311903
STEP = 1134903170
CELL_BITS = 19


def word_count(text: str):
    """Words of a text column; null counts 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per source: null last, numbered by code point, with its size and target.

    Weights repeat over the numbers. ``share`` of all words is divided by weight; no target is
    above ``cap`` times its source, and what a source can't take goes to the others by weight.
    The common rate at which that settles is found by one pass over the sources in the order in
    which they reach their limit. All words 0: all targets 0.
    """
    everything = W.partitionBy()
    rows = sizes.groupBy("s_null", "s").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    rows = rows.withColumn("k", F.row_number().over(everything.orderBy("s_null", "s")) - 1)
    rows = rows.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("k") % len(weights) + 1).cast("int")))
    rows = rows.withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    rows = rows.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
    filling = everything.orderBy(F.col("limit") / F.col("weight"), "k")
    full = F.coalesce(F.sum("limit").over(filling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(filling.rowsBetween(0, W.unboundedFollowing))
    rows = rows.withColumn("rate", (F.col("total") - full) / rest)
    settles = F.when(F.col("rate") * F.col("weight") <= F.col("limit"), F.struct(F.col("limit") / F.col("weight"), "k", "rate"))
    rate = F.min(settles).over(everything)["rate"]
    rows = rows.withColumn("target", F.least("limit", F.coalesce(rate, F.lit(2.0**62)) * F.col("weight")))
    return rows.withColumn("words", F.floor("target").cast("bigint"))


def slot_schedule(targets: DataFrame, n_blocks: int, block: int = BLOCK) -> DataFrame:
    """Slots (slot, k, rank): which source and which of its blocks each place of the mix takes.

    A source's share of [0, 1) is its share of the ``n_blocks`` blocks that the targets come to.
    Gaps between n points of the golden ratio are below 1.95 / n, so among 2 * n_blocks points a
    source meets at least as many as it has blocks: the points alone reach every target, and a
    source takes no slot after that. Slots left out that way are gaps in the numbering.

    Points are matched to sources by equal cells of [0, 1), then by the exact bounds, so a
    source with a third of the weight is spread over a third of the cells. Every source has one
    grid point of its own or more, however many words the others have.
    """
    spark = targets.sparkSession
    ordered = W.partitionBy().orderBy("k")
    bounds = targets.filter("words > 0").withColumn("need", F.ceil(F.col("words") / block).cast("bigint"))
    upto, number = F.sum("need").over(ordered.rowsBetween(W.unboundedPreceding, 0)), F.row_number().over(ordered)
    room = F.lit(GRID) - F.count(F.lit(1)).over(W.partitionBy())
    bounds = bounds.withColumn("hi", number + F.floor(upto / F.sum("need").over(W.partitionBy()) * room).cast("bigint"))
    bounds = bounds.withColumn("lo", F.coalesce(F.lag("hi").over(ordered), F.lit(0).cast("bigint")))
    cells = bounds.select(
        "k", "lo", "hi", "need",
        F.explode(F.sequence(F.shiftright("lo", CELL_BITS), F.shiftright(F.col("hi") - 1, CELL_BITS))).alias("cell"))
    points = spark.range(2 * n_blocks).select(F.col("id").alias("slot"), (F.col("id") % GRID * STEP % GRID).alias("u"))
    points = points.withColumn("cell", F.shiftright("u", CELL_BITS))
    slots = points.join(cells, "cell").filter("u >= lo and u < hi").select("slot", "k", "need")
    slots = slots.withColumn("part", F.floor(F.col("slot") / 4096)).withColumn("one", F.lit(1).cast("bigint"))
    slots = running_before(staged(slots, "slots"), ["k"], "part", ["slot"], "one", "rank")
    return slots.filter("rank < need").select("slot", "k", "rank")


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights=WEIGHTS,
        share: float = 1.5, cap: float = 2.0, block: int = BLOCK, seed: int = 17) -> DataFrame:
    """What the mix takes of each document: doc_id, text_hash, size, source_size, target, taken, first_slot, n_slots.

    ``taken`` is the words of the document in the blocks that slots took, repeats counted;
    ``first_slot`` the earliest of these slots, the document's place in the order of the mix (null:
    not taken), ``n_slots`` their number. One row per input row. Null and empty texts have size 0 and are never taken; a null source is
    a source of its own; repeated rows are separate documents. Other columns are ignored. The
    order within a source is a hash of id and text, so reruns agree.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), word_count(text).alias("size"),
        F.col(source).isNull().alias("s_null"), F.coalesce(F.col(source), F.lit("")).alias("s"),
        F.xxhash64(F.lit(seed), doc_id, text).alias("shuffled"))
    rows = staged(rows, "sizes")
    targets = staged(source_targets(rows, weights, share, cap), "targets")
    blocks = F.ceil(F.col("words") / block).cast("bigint")
    n_docs, n_blocks = targets.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum(blocks), F.lit(0))).first()
    rows = rows.join(targets.select("s_null", "s", "k", "source_size", "target", "words"), ["s_null", "s"])
    rows = rows.withColumn("part", F.pmod("shuffled", F.lit(buckets_of(n_docs)))).drop("s_null", "s")
    order = ["shuffled", "doc_id", "text_hash", "size"]
    placed = rows.withColumn("nth", F.row_number().over(W.partitionBy("k", "part").orderBy(*order)))
    placed = running_before(staged(placed, "placed"), ["k"], "part", ["nth"], "size", "begin")
    spans = F.expr(
        f"""flatten(transform(sequence(0, {max(0, int(-(-cap // 1)) - 1)}), e -> if(
        size > 0 and begin + e * source_size < words,
        transform(sequence((begin + e * source_size) div {block},
                           (least(begin + e * source_size + size, words) - 1) div {block}),
                  r -> named_struct('rank', r, 'part_words',
                       least(begin + e * source_size + size, words, (r + 1) * {block})
                       - greatest(begin + e * source_size, r * {block}))),
        cast(array() as array<struct<rank:bigint,part_words:bigint>>))))""")
    pieces = placed.select("*", F.explode_outer(spans).alias("piece")).select("*", "piece.rank", "piece.part_words").drop("piece")
    met = pieces.join(slot_schedule(targets, n_blocks, block), ["k", "rank"], "left")
    taken = F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("part_words"))), F.lit(0)).cast("bigint")
    return (met.groupBy("k", "part", "nth", "doc_id", "text_hash", "size", "source_size", "target")
            .agg(taken.alias("taken"), F.min("slot").alias("first_slot"), F.count("slot").alias("n_slots"))
            .drop("k", "part", "nth"))


def op2_mix_sources(spark, directory):
    return mix(table(spark, directory, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_slot", "n_slots")
