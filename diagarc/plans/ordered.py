"""Ordered windows over groups of any size.

A plain window sorts each group in one task, so a group that holds a third of
the table becomes the whole job. Here rows are range-partitioned by (keys, order)
first: a hot group spans many slices of about equal size, each slice is windowed
on its own, and what earlier slices of the same group contribute is carried in by
a small table. A range slice can only be continued by the next one, so at most one
group per slice needs a carry: the carry table has fewer rows than there are
slices, which is why it may be broadcast.

Range bounds come from sampling. The slicing is therefore frozen in the shared
folder before both branches read it, and a lost executor cannot move a bound.

Groups with a bound of their own (the samples of one chunk) use plain windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from diagarc.plans.shared import freeze

SLICE = "_slice"


def slice_rows(df: DataFrame, keys: list[str], order: list[str], n: int | None = None) -> DataFrame:
    """``df`` with a slice number, frozen. Slices follow (keys, order).

    Rows that already carry a slice number keep it, so several ordered steps on the
    same keys and order share one slicing.
    """
    if SLICE in df.columns:
        return df
    if n is None:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *keys, *order)
    return freeze(ranged.withColumn(SLICE, F.spark_partition_id()))


def _own_slice(df: DataFrame) -> list[str]:
    return [] if SLICE in df.columns else [SLICE]


def _local(keys: list[str], order: list[str]):
    return W.partitionBy(SLICE, *keys).orderBy(*order)


def _carry(sliced: DataFrame, keys: list[str], parts: list[Column], carried: dict[str, tuple[str, str]]) -> DataFrame:
    """Rows (slice, keys, carried columns) of groups that began in an earlier slice.

    ``parts`` summarise a group's rows of one slice; ``carried`` maps an output to
    (how to combine, summary column) over the group's earlier slices.
    """
    earlier = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    combine = {"sum": F.sum, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}
    summary = sliced.groupBy(SLICE, *keys).agg(F.count(F.lit(1)).alias("_n"), *parts)
    columns = [combine[how](F.col(c)).over(earlier).alias(out) for out, (how, c) in carried.items()]
    rows = summary.select(SLICE, *keys, F.count(F.lit(1)).over(earlier).alias("_before"), *columns)
    rows = rows.filter("_before > 0").drop("_before")
    return rows.select(F.col(SLICE).alias("_cs"), *[F.col(k).alias(f"_c_{k}") for k in keys], *carried)


def _bring(local: DataFrame, keys: list[str], carry: DataFrame) -> DataFrame:
    on = local[SLICE] == carry["_cs"]
    for k in keys:
        on = on & local[k].eqNullSafe(carry[f"_c_{k}"])
    joined = local.join(F.broadcast(carry), on, "left")
    return joined.drop("_cs", *[f"_c_{k}" for k in keys])


def number_rows(df: DataFrame, keys: list[str], order: list[str], out="row_no", n=None) -> DataFrame:
    """1-based row number per group."""
    sliced = slice_rows(df, keys, order, n)
    carry = _carry(sliced, keys, [], {"_rows": ("sum", "_n")})
    local = sliced.withColumn(out, F.row_number().over(_local(keys, order)).cast("bigint"))
    joined = _bring(local, keys, carry)
    return joined.withColumn(out, F.col(out) + F.coalesce("_rows", F.lit(0))).drop("_rows", *_own_slice(df))


def previous_row(df: DataFrame, keys: list[str], order: list[str], columns: list[str], out="previous", n=None):
    """Struct of ``columns`` of the row before, NULL at the start of a group."""
    rows = df.withColumn("_row_struct", F.struct(*columns))
    return running(rows, keys, order, {out: ("lag", "_row_struct")}, n).drop("_row_struct")


def running(df: DataFrame, keys: list[str], order: list[str], outs: dict[str, tuple[str, str]], n=None) -> DataFrame:
    """Running values per group, several at once.

    ``outs`` maps a new column to (how, input column): ``"sum"`` and ``"max"`` up to and
    with the row, ``"last"`` the latest value that is not NULL, ``"lag"`` the value of the
    row before (of a column without NULLs, such as a struct).

    The result reads the slices twice. A step on top of another step therefore starts
    from :func:`refreeze`, or the work would double with every step.
    """
    sliced = slice_rows(df, keys, order, n)
    w = _local(keys, order)
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    parts, carried, local = [], {}, sliced
    for out, (how, c) in outs.items():
        if how == "sum" or how == "max":
            agg = F.sum if how == "sum" else F.max
            part, value = agg(c), agg(c).over(upto)
        elif how == "last":
            known = F.col(c).isNotNull()
            part = F.max_by(F.when(known, F.struct(F.col(c).alias("v"))), F.when(known, F.struct(*order)))["v"]
            value = F.last(c, ignorenulls=True).over(upto)
        else:
            part, value = F.max_by(c, F.struct(*order)), F.lag(c).over(w)
        parts.append(part.alias(f"_p_{out}"))
        local = local.withColumn(out, value)
        carried[f"_in_{out}"] = ("last" if how == "lag" else how, f"_p_{out}")
    joined = _bring(local, keys, _carry(sliced, keys, parts, carried))
    for out, (how, _) in outs.items():
        before, own = F.col(f"_in_{out}"), F.col(out)
        if how == "sum":
            total = F.when(before.isNull(), own).otherwise(before + F.coalesce(own, before - before))
        elif how == "max":
            total = F.greatest(own, before)
        else:
            total = F.coalesce(own, before)
        joined = joined.withColumn(out, total)
    return joined.drop(*_own_slice(df), *carried)


def refreeze(sliced: DataFrame) -> DataFrame:
    """Materialise a step that kept its slices, for the next step to start from."""
    return freeze(sliced)
