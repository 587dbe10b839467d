"""What happens to rows that carry an ``error``.

``failfast`` aborts the job at the first bad row, which is what a single-file
import does. ``permissive`` keeps good rows and leaves bad ones to
:func:`split_errors` / :func:`decode_errors`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODES = ("failfast", "permissive")


def apply_mode(df: DataFrame, mode: str) -> DataFrame:
    """Guard ``df`` (with an ``error`` column). The guard is a filter, so no later
    projection can prune it away."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "permissive":
        return df
    message = F.concat_ws(" ", F.lit("cannot decode"), F.col("path"), F.col("doc_no").cast("string"), F.col("error"))
    return df.filter(F.when(F.col("error").isNull(), True).otherwise(F.raise_error(message).cast("boolean")))


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, side table of bad rows with their error class)."""
    bad = df.filter(F.col("error").isNotNull()).select("path", "doc_no", error_class().alias("error_class"), "error")
    return df.filter(F.col("error").isNull()), bad


def error_class():
    return F.substring_index("error", ":", 1)


def decode_errors(*tables: DataFrame) -> DataFrame:
    """Rows per error class over any tables that have an ``error`` column."""
    bad = None
    for df in tables:
        part = df.filter(F.col("error").isNotNull()).select(error_class().alias("error_class"))
        bad = part if bad is None else bad.unionByName(part)
    return bad.groupBy("error_class").agg(F.count(F.lit(1)).alias("n_rows"))
