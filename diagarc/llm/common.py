"""Shared pieces of the operators in this subpackage: tables, Arrow stages, running sums."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from diagarc.plans.shared import run_dir


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that lost executors recompute nothing above it."""
    path = run_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more: what was made of them is staged itself.

    Spark removes the shuffle files of plans that are gone when the driver collects garbage, which
    may be long after; so that is asked for here.
    """
    for df in tables:
        jvm, session = df.sparkSession._jvm, df.sparkSession
        at = jvm.org.apache.hadoop.fs.Path(df.staged_path)
        at.getFileSystem(session._jsc.hadoopConfiguration()).delete(at, True)
    gc.collect()
    for df in tables[:1]:
        df.sparkSession._jvm.java.lang.System.gc()


_kept: dict = {}


def kept(key: str, make: Callable):
    """``make()``, which a worker keeps for its later tasks until ``let_go``."""
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def let_go(but: str | None = None) -> None:
    """Free what this worker keeps, except under one key."""
    for key in _kept.keys() - {but}:
        del _kept[key]


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType, keep: str | None = None) -> DataFrame:
    """``function`` over every Arrow batch of ``df``, without a shuffle.

    Workers outlive an operator, and what they keep would add to the memory of the next one: a task
    lets go of all that is not ``kept`` under the key ``keep``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(keep)
        for batch in batches:
            if batch.num_rows and (out := function(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def slices(texts: list, limit: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Bounds of runs of consecutive texts of about ``limit`` units; a longer text is a run of its own."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        size = len(text)
        if i > begin and held + size > limit:
            yield begin, i
            begin, held = i, 0
        held += size
    if begin < len(texts):
        yield begin, len(texts)


def buckets_of(n_rows: int, each: int = 2000) -> int:
    """How many hash buckets give about ``each`` rows, for two-level ranks and sums."""
    return max(1, -(-n_rows // each))


def running_before(df: DataFrame, keys: list[str], bucket: str, order: list[str], amount: str, out: str) -> DataFrame:
    """Sum of ``amount`` over the rows of the same keys that come earlier by (bucket, order).

    A key may hold any share of the rows: only rows of one (key, bucket) meet in a task, and
    one row per (key, bucket) is summed over the buckets. ``df`` is read twice, so stage it.
    """
    totals = df.groupBy(*keys, bucket).agg(F.sum(amount).alias("_sum"))
    earlier = W.partitionBy(*keys).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.withColumn("_offset", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    inside = W.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = df.withColumn("_local", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return local.join(offsets, [*keys, bucket]).withColumn(out, F.col("_local") + F.col("_offset")).drop("_local", "_offset")
