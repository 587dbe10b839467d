"""Encode and decode steps as operators over ordinary long tables.

:mod:`diagarc.operators.decode` does the same work inside the task that has the
bytes at hand. These operators serve rows that are already in tables: tokens kept
from an earlier read, change points, or samples of any origin. Windows are per
chunk or per key of a chunk, groups that the writer bounds when it closes a full
chunk; one hash partitioning on (path, doc_no) serves every window of a pipeline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from diagarc.functions.scalar import wrap_sub, wrap_sum
from diagarc.operators.decode import AXIS_NAME
from diagarc.plans.ordered import previous_row

CHUNK = ["path", "doc_no"]
CELLS_PER_TASK = 1 << 17  # a chunk with more has a task of its own


def by_chunk(df: DataFrame, n: int | None = None) -> DataFrame:
    """The one partitioning the chunk windows below share, in ``n`` tasks (:func:`chunk_tasks`).

    Without a count Spark chooses it by the bytes that move. Those are compressed: rows take
    many times as much in memory, and the windows sort them several times in one task.
    """
    return df.repartition(*CHUNK) if n is None else df.repartition(n, *CHUNK)


def chunk_tasks(chunks: DataFrame) -> int:
    """Tasks for :func:`by_chunk` by the cells of ``decode_chunks`` rows, so that more chunks are more tasks and not larger ones."""
    cells = chunks.agg(F.sum(F.col("n_keys_found") * (F.col("n_deltas") + 1))).first()[0] or 0
    return max(1, -(-cells // CELLS_PER_TASK))


def delta_encode(df: DataFrame, keys: list[str], order: list[str], value="value", out="delta", bounded=False):
    """Value minus the previous value of the group, NULL for its first row.

    Set ``bounded`` when a group is one key of one chunk; groups of unknown size take
    the sliced path.
    """
    if bounded:
        previous = F.lag(value).over(W.partitionBy(*keys).orderBy(*order))
        return df.withColumn(out, wrap_sub(F.col(value), previous))
    rows = previous_row(df, keys, order, [value], "_previous")
    return rows.withColumn(out, wrap_sub(F.col(value), F.col("_previous")[value])).drop("_previous")


def cells(deltas: DataFrame, order: list[str]) -> DataFrame:
    """Number the deltas of a chunk from 0 in metric-major order."""
    return deltas.withColumn("cell", F.row_number().over(W.partitionBy(*CHUNK).orderBy(*order)).cast("bigint") - 1)


def zero_run_encode(deltas: DataFrame) -> DataFrame:
    """(path, doc_no, cell, delta) to tokens; n zeros in a row become ``0, n - 1``.

    A group is one non-zero delta and the zeros after it, so a group gives at most
    three tokens.
    """
    w = W.partitionBy(*CHUNK).orderBy("cell").rowsBetween(W.unboundedPreceding, 0)
    grouped = deltas.withColumn("grp", F.count(F.when(F.col("delta") != 0, 1)).over(w))
    runs = grouped.groupBy(*CHUNK, "grp").agg(
        F.max(F.when(F.col("delta") != 0, F.col("delta"))).alias("head"),
        F.count(F.when(F.col("delta") == 0, 1)).alias("zeros"),
    )
    none = F.array().cast("array<bigint>")
    head = F.when(F.col("head").isNotNull(), F.array("head")).otherwise(none)
    tail = F.when(F.col("zeros") > 0, F.array(F.lit(0).cast("bigint"), F.col("zeros") - 1)).otherwise(none)
    tokens = runs.select(*CHUNK, "grp", F.posexplode(F.concat(head, tail)).alias("pos", "token"))
    number = F.row_number().over(W.partitionBy(*CHUNK).orderBy("grp", "pos")).cast("bigint") - 1
    return tokens.select(*CHUNK, number.alias("token_no"), "token")


def _token_spans(tokens: DataFrame) -> DataFrame:
    """Delta tokens with the cells they cover. In a stretch of zeros every other one,
    starting with the first, is a marker; the token after a marker is its count."""
    rows = tokens.select(*CHUNK, "n_keys_found", "n_deltas", F.posexplode("tokens").alias("pos", "token"))
    w = W.partitionBy(*CHUNK).orderBy("pos")
    other = F.max(F.when(F.col("token") != 0, F.col("pos"))).over(w.rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("marker", (F.col("token") == 0) & ((F.col("pos") - F.coalesce(other, F.lit(-1))) % 2 == 1))
    need = F.col("n_keys_found") * F.col("n_deltas")
    count = F.lead("token").over(w)
    count = F.when((count < 0) | (count > need), need).otherwise(count)  # too large either way
    rows = rows.select(
        "*", need.alias("need"), F.coalesce(F.lag("marker").over(w), F.lit(False)).alias("is_count"),
        F.when(F.col("marker"), count + 1).otherwise(F.lit(1).cast("bigint")).alias("span"),
    ).filter(~F.col("is_count"))
    before = w.rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("cell", F.coalesce(F.sum("span").over(before), F.lit(0).cast("bigint")))


def expand_zero_runs(tokens: DataFrame) -> DataFrame:
    """``chunk_tokens`` rows to (path, doc_no, key_no, sample_no, delta) of non-zero deltas."""
    at = F.col("cell")
    n = F.nullif("n_deltas", F.lit(0).cast("bigint"))
    return _token_spans(tokens).filter((F.col("token") != 0) & (at < F.col("need"))).select(
        *CHUNK, F.call_function("div", at, n).cast("int").alias("key_no"),
        (at % n + 1).cast("int").alias("sample_no"), F.col("token").alias("delta"),
    )


def stream_complete(tokens: DataFrame) -> DataFrame:
    """(path, doc_no, error) of every chunk; NULL error where its tokens fit exactly."""
    span, cell, need = F.col("span"), F.col("cell"), F.col("need")
    per_chunk = _token_spans(tokens).groupBy(*CHUNK).agg(
        F.max(need).alias("need"),
        F.max(F.when(cell < need, F.when(span.isNull(), 1).otherwise(0))).alias("cut_off"),
        F.max(F.when((cell < need) & (cell + span > need), 1).otherwise(0)).alias("run_left"),
        F.max(F.when(cell >= need, 1).otherwise(0)).alias("left"),
        F.sum("span").alias("covered"),
    )
    all_chunks = tokens.select(*CHUNK, (F.col("n_keys_found") * F.col("n_deltas")).alias("all_need"))
    rows = all_chunks.join(per_chunk, CHUNK, "left")
    covered = F.coalesce("covered", F.lit(0).cast("bigint"))
    error = (
        F.when((F.col("cut_off") == 1) | (covered < F.col("all_need")), "bad_varint")
        .when(F.col("run_left") == 1, "zero_run_left")
        .when(F.col("left") == 1, "tokens_left")
    )
    return rows.select(*CHUNK, error.alias("error"))


def delta_decode(points: DataFrame) -> DataFrame:
    """Running 64-bit wrapping sum per key over ``change_pts`` rows (base at sample 0)."""
    w = W.partitionBy(*CHUNK, "key_no").orderBy("sample_no").rowsBetween(W.unboundedPreceding, 0)
    return points.withColumn("value", wrap_sum(F.col("delta"), w))


def densify(values: DataFrame) -> DataFrame:
    """Repeat each value up to the next change, ``n_deltas + 1`` samples per key."""
    w = W.partitionBy(*CHUNK, "key_no").orderBy("sample_no")
    stop = F.coalesce(F.lead("sample_no").over(w), F.col("n_deltas").cast("int") + 1)
    rest = [c for c in values.columns if c not in ("sample_no", "delta", "n_deltas")]
    rows = values.withColumn("stop", stop)
    return rows.select(*rest, F.explode(F.sequence("sample_no", F.col("stop") - 1)).alias("sample_no"))


def time_axis(samples: DataFrame) -> DataFrame:
    """Give every sample of a chunk the value of its ``start`` series as ``ts_ms``.

    With repeated ``start`` keys the last one wins; samples of a chunk without one are left out.
    A window over the keys of one sample: it keeps the partitioning of the chunk windows before
    it, and its input is computed once.
    """
    start = F.when(F.col("name") == AXIS_NAME, F.struct("key_no", "value"))
    axis = F.max(start).over(W.partitionBy(*CHUNK, "sample_no"))
    return samples.withColumn("ts_ms", axis["value"]).filter("ts_ms is not null")


def series_of(samples: DataFrame) -> DataFrame:
    """D12 on a stored ``samples`` table."""
    points = F.array_sort(F.collect_list(F.struct("sample_no", "value", "ts_ms")))
    rows = samples.groupBy(*CHUNK, "key_no", "name").agg(points.alias("p"))
    return rows.select(
        *CHUNK, "key_no", "name", F.transform("p", lambda p: p["value"]).alias("values"),
        F.transform("p", lambda p: p["ts_ms"]).alias("ts_ms"),
    )


def samples_of(series: DataFrame) -> DataFrame:
    """Zip values with timestamps; different lengths are an error."""
    same = F.size("values") == F.size("ts_ms")
    guard = F.when(same, True).otherwise(F.raise_error(F.lit("values and timestamps differ in length")).cast("boolean"))
    rows = series.filter(guard).select(
        *CHUNK, "key_no", "name", F.posexplode(F.arrays_zip("ts_ms", "values")).alias("sample_no", "p")
    )
    return rows.select(*CHUNK, "key_no", "name", "sample_no", F.col("p.ts_ms").alias("ts_ms"), F.col("p.values").alias("value"))
