"""D8/D11 in summary: metrics per tumbling window, from change points alone.

A metric is a step function: a sample's value is in force until the next sample of its
chunk. Runs of equal values are cut where windows begin, so the work follows the number of
changes and of windows, not of samples, and windows without a sample of their own get the
value carried into them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diagarc.operators.decode import _keys_of

#: Longest window. Sums are kept as two halves of 32 bits times milliseconds, which fit a bigint up to here.
MOST_MS = 1 << 30


def _window_of(ts, width_ms):
    return ts - F.pmod(ts, F.lit(width_ms))


def window_parts(chunks: DataFrame, width_ms: int) -> DataFrame:
    """Runs cut at window borders: one row per run and window it is in force in, no shuffle.

    ``from_ms`` and ``to_ms`` are the part's ends within its window ``window_ms``; ``closes`` marks
    the last part of its chunk, key and window. The last sample of a chunk holds its value for
    no time, yet is a part. A chunk's times are expected not to fall; a run that ends before it
    begins is one part of no length. Chunks with an error have no parts.
    """
    if not 0 < width_ms <= MOST_MS:
        raise ValueError(f"width_ms: {width_ms!r}")
    width = F.lit(width_ms).cast("bigint")
    final = F.col("n_deltas").cast("int")
    runs = _keys_of(chunks).select("*", F.posexplode("at").alias("i", "lo"))
    stop = F.coalesce(F.get("at", F.col("i") + 1), final + 1)
    runs = runs.select(
        "path", "doc_no", "key_no", "name", F.get("val", F.col("i")).alias("value"), (stop > final).alias("ends_chunk"),
        F.get("axis", F.col("lo")).alias("start_ms"), F.get("axis", stop - 1).alias("last_ms"),
        F.get("axis", F.least(stop, final)).alias("end_ms"),
    )
    # A run ends with the next run's first moment, which is not its own; its last sample is, however short.
    reach = F.greatest("start_ms", "last_ms", F.col("end_ms") - 1)
    reach = F.when(F.col("ends_chunk"), F.greatest("start_ms", "last_ms")).otherwise(reach)
    first, last = _window_of(F.col("start_ms"), width_ms), _window_of(reach, width_ms)
    parts = runs.select("*", F.explode(F.sequence(first, last, width)).alias("window_ms"))
    from_ms = F.greatest("start_ms", "window_ms")
    to_ms = F.greatest(from_ms, F.least(F.col("end_ms"), F.col("window_ms") + width))
    return parts.select(
        "path", "doc_no", "key_no", "name", "window_ms", from_ms.alias("from_ms"), to_ms.alias("to_ms"), "value",
        (F.col("ends_chunk") | (_window_of(F.col("end_ms"), width_ms) != F.col("window_ms"))).alias("closes"),
    )


def rollup(chunks: DataFrame, width_ms: int, by=("path", "name")) -> DataFrame:
    """Per ``by`` and window of ``width_ms``: time-weighted mean, least, greatest and last value.

    ``chunks`` are :func:`~diagarc.operators.decode.decode_chunks` rows. Windows begin at multiples of the width.
    ``held_ms`` is the time that the values cover; between chunks none is known, so it may be less than the width, and
    more where ``by`` joins several series. ``mean_value`` is NULL where nothing lasted. ``last_value``
    belongs to the part that ends last; of several that end in one millisecond the greatest counts. Parts combine in their
    tasks before one shuffle by (``by``, window).
    """
    parts = window_parts(chunks, width_ms)
    held = F.col("to_ms") - F.col("from_ms")
    # End and value as one number: a decimal can be updated in place, so the aggregate hashes; a struct would make it sort.
    two64, two63 = F.lit(str(1 << 64)).cast("decimal(20,0)"), F.lit(str(1 << 63)).cast("decimal(20,0)")
    ends = (F.col("to_ms") - F.col("window_ms")).cast("decimal(10,0)")
    latest = F.when(F.col("closes"), (ends * two64 + F.col("value").cast("decimal(20,0)") + two63).cast("decimal(30,0)"))
    rows = parts.groupBy(*by, "window_ms").agg(
        F.sum(held).alias("held_ms"),
        F.sum(F.shiftright("value", 32) * held).alias("_high"),
        F.sum(F.col("value").bitwiseAND(F.lit((1 << 32) - 1)) * held).alias("_low"),
        F.min("value").alias("min_value"), F.max("value").alias("max_value"), F.max(latest).alias("_latest"),
    )
    total = F.col("_high").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("_low").cast("decimal(20,0)")
    mean = total.cast("double") / F.nullif(F.col("held_ms"), F.lit(0).cast("bigint"))
    last_value = (F.col("_latest") % two64 - two63).cast("bigint")
    return rows.select(*by, "window_ms", "held_ms", mean.alias("mean_value"), "min_value", "max_value", last_value.alias("last_value"))
