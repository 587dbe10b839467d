"""Sizes of tokens and where chunks begin. (E1 and E2 are in ``long_tables``,
E5 in ``sources.writer``.)"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from diagarc.functions.scalar import int_div, varint_size
from diagarc.plans.ordered import SLICE, number_rows, slice_rows

MAX_SAMPLES = 300  # reference sample and 299 deltas


def token_sizes(tokens: DataFrame, keys: list[str], token="token") -> DataFrame:
    """Encoded bytes against 8-byte words per group."""
    return tokens.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_tokens"), F.sum(varint_size(F.col(token))).cast("bigint").alias("n_bytes"),
        (F.count(F.lit(1)) * 8).alias("n_word_bytes"),
    )


def fill_chunks(rows: DataFrame, keys: list[str], order: list[str], max_samples=MAX_SAMPLES) -> DataFrame:
    """E4 for one schema: ``doc_no`` and ``sample_no``, a new chunk whenever one is full."""
    at = F.col("_row") - 1
    numbered = number_rows(rows, keys, order, "_row")
    return numbered.withColumn("doc_no", int_div(at, max_samples)).withColumn(
        "sample_no", (at % max_samples).cast("int")).drop("_row")


def chunk_boundaries(rows: DataFrame, keys: list[str], order: list[str], schema_column: str,
                     max_samples=MAX_SAMPLES) -> DataFrame:
    """``doc_no`` and ``sample_no`` per row; a chunk ends when the schema changes or it is full.

    One slicing, frozen once. Each slice counts its own runs of equal schema; one row per group
    and slice says how it begins and ends, and those few rows are folded in order into what
    each slice starts with: the schema before, how long its run is already, the chunks begun.
    """
    sliced = slice_rows(rows, keys, order)
    schema = F.struct(F.col(schema_column).alias("v"))
    here = W.partitionBy(SLICE, *keys).orderBy(*order)
    upto = here.rowsBetween(W.unboundedPreceding, 0)
    previous = F.lag(schema).over(here)
    new = previous.isNull() | ~previous["v"].eqNullSafe(F.col(schema_column))
    local = sliced.withColumn("_run", F.sum(new.cast("bigint")).over(upto))
    local = local.withColumn("_at", F.row_number().over(W.partitionBy(SLICE, *keys, "_run").orderBy(*order)).cast("bigint") - 1)

    place = F.struct(*order)
    ends = local.groupBy(SLICE, *keys).agg(
        F.min_by(schema, place).alias("head"), F.max_by(schema, place).alias("tail"), F.max("_run").alias("runs"),
        F.sum((F.col("_run") == 1).cast("bigint")).alias("first"), (F.max_by("_at", place) + 1).alias("last"),
        F.sum(((F.col("_run") > 1) & (F.col("_at") % max_samples == 0)).cast("bigint")).alias("begun"))
    # Few rows, one per group and slice, in windows over a group's slices. A slice goes on with the
    # run before it if its head equals that slice's tail; lengths add up over slices of one run.
    by_slice = W.partitionBy(*keys).orderBy(SLICE)
    earlier = by_slice.rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    fold = ends.withColumn("_goes_on", F.lag("tail").over(by_slice).isNotNull() & F.lag("tail").over(by_slice)["v"].eqNullSafe(F.col("head")["v"]))
    fold = fold.withColumn("_anew", ~F.col("_goes_on") | (F.lag("runs").over(by_slice) > 1))
    fold = fold.withColumn("_ahead", F.coalesce(F.sum("first").over(earlier), zero))
    base = F.when(F.col("_goes_on"), F.lag("last").over(by_slice)).otherwise(zero)
    fold = fold.withColumn("_base", F.last(F.when(F.col("_anew"), base - F.col("_ahead")), ignorenulls=True).over(by_slice))
    fold = fold.withColumn("before", F.col("_base") + F.col("_ahead"))
    chunks = int_div(F.col("before") + F.col("first") + (max_samples - 1), max_samples) - int_div(F.col("before") + (max_samples - 1), max_samples)
    fold = fold.withColumn("docs", F.coalesce(F.sum(chunks + F.col("begun")).over(earlier), zero))
    carried = fold.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col(SLICE).alias("_cs"), "before", "docs")
    on = local[SLICE] == carried["_cs"]
    for k in keys:
        on = on & local[k].eqNullSafe(carried[f"_c_{k}"])
    # Fewer rows than slices: only the first group of a slice began before it, and one row begins it.
    joined = local.join(carried, on, "left")
    at = F.col("_at") + F.when(F.col("_run") == 1, F.coalesce("before", F.lit(0))).otherwise(0)
    joined = joined.withColumn("sample_no", (at % max_samples).cast("int"))
    doc = F.sum((F.col("sample_no") == 0).cast("bigint")).over(upto) + F.coalesce("docs", F.lit(0)) - 1
    return joined.withColumn("doc_no", doc).select(*rows.columns, "doc_no", "sample_no")
