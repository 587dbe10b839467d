"""Metadata deltas and metadata as of a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from diagarc.plans.ordered import SLICE, previous_row, running, slice_rows

ALWAYS_KEPT = ("start", "end")  # fixed values: fields every delta repeats


def metadata_delta(docs: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Documents with ordered ``fields`` to (``doc_type``, ``index``, changed ``fields``).

    Each document is compared with the one before it, one level deep. A change of
    field count or names gives a whole document (type 0) and resets the counter; a
    document without changes gives no row.
    """
    sliced = slice_rows(docs, keys, order)
    a = previous_row(sliced, keys, order, ["fields"], "_previous")
    before = F.col("_previous")["fields"]

    def names(fields):
        return F.transform(fields, lambda f: f["name"])

    reset = F.col("_previous").isNull() | (names(F.col("fields")) != names(before))
    differs = F.filter("fields", lambda f, i: ~f["value"].eqNullSafe(F.get(before, i)["value"]) & ~f["name"].isin(*ALWAYS_KEPT))
    kept = F.filter(
        "fields",
        lambda f, i: f["name"].isin(*ALWAYS_KEPT) | ~f["value"].eqNullSafe(F.get(before, i)["value"]),
    )
    a = a.withColumn("_reset", reset).withColumn("_delta", F.when(~reset, kept))
    a = a.withColumn("_hit", F.when(~F.col("_reset") & (F.size(differs) > 0), 1).otherwise(0).cast("bigint"))
    # Documents without changes have given what they can: they were someone's
    # predecessor. They leave before the counting.
    a = a.filter(F.col("_reset") | (F.col("_hit") == 1)).drop("_previous")
    # Deltas so far in the slice, less those before the latest reset. The count never falls, so
    # the latest reset's count is the largest one seen at a reset.
    upto = W.partitionBy(SLICE, *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    a = a.withColumn("_hits", F.sum("_hit").over(upto))
    a = a.withColumn("_base", F.max(F.when(F.col("_reset"), F.col("_hits"))).over(upto))
    # Until its first reset a slice goes on counting where the slices before it ended.
    ends = a.groupBy(SLICE, *keys).agg(F.max("_hits").alias("hits"), F.max("_base").alias("base"))
    zero = F.lit(0).cast("bigint")
    by_slice = W.partitionBy(*keys).orderBy(SLICE)
    fold = ends.withColumn("_sum", F.sum("hits").over(by_slice))
    fold = fold.withColumn("_start", F.last(F.col("_sum") - (F.col("hits") - F.col("base")), ignorenulls=True).over(by_slice))
    fold = fold.withColumn("_count", F.lag(F.col("_sum") - F.coalesce("_start", zero)).over(by_slice))
    carried = fold.filter("_count is not null").select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col(SLICE).alias("_cs"), "_count")
    on = a[SLICE] == carried["_cs"]
    for k in keys:
        on = on & a[k].eqNullSafe(carried[f"_c_{k}"])
    c = a.join(carried, on, "left")
    return c.select(
        *[x for x in docs.columns if x != "fields"],
        F.when(F.col("_reset"), 0).otherwise(2).alias("doc_type"),
        (F.col("_hits") - F.coalesce("_base", -F.coalesce("_count", zero))).alias("index"),
        F.when(F.col("_reset"), F.col("fields")).otherwise(F.col("_delta")).alias("fields"),
    )


def metadata_as_of(deltas: DataFrame, keys: list[str], order: list[str], until=None) -> DataFrame:
    """Latest value per field, over documents whose first order column is at most ``until``.

    A plain aggregate: each task sends one row per source and field.
    """
    if until is not None:
        deltas = deltas.filter(F.col(order[0]) <= F.lit(until))
    rows = deltas.select(*keys, *order, F.explode("fields").alias("f"))
    latest = F.max_by(F.col("f.value"), F.struct(*order))
    return rows.groupBy(*keys, F.col("f.name").alias("name")).agg(latest.alias("value"))


def metadata_history(deltas: DataFrame, keys: list[str], order: list[str], names: list[str]) -> DataFrame:
    """E7, running form: value of each named field as of every document."""
    rows = deltas
    for n in names:
        found = F.filter("fields", lambda f: f["name"] == n)
        rows = rows.withColumn(f"_in_doc_{n}", F.get(found, F.lit(0))["value"])
    out = running(rows, keys, order, {n: ("last", f"_in_doc_{n}") for n in names})
    return out.select(*keys, *order, *names)
