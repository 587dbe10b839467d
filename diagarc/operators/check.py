"""What was captured, without decoding more than the question needs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diagarc.plans.ordered import number_rows, running


def _keys(chunks: DataFrame) -> DataFrame:
    rows = chunks.select("path", "doc_no", "n_deltas", F.explode_outer("keys").alias("k"))
    return rows.select("path", "doc_no", "n_deltas", "k.key_no", "k.name", "k.bson_type", "k.base")


def check_totals(chunks: DataFrame) -> DataFrame:
    """Chunks, series over all chunks, and distinct names, in one pass.

    Counts are first taken per name, where map-side combining collapses the names
    that repeat in every chunk; a chunk is counted at its first key.
    """
    first = F.coalesce("key_no", F.lit(0)) == 0
    per_name = _keys(chunks).groupBy("name").agg(
        F.count(F.when(first, 1)).alias("chunks"), F.count("key_no").alias("series")
    )
    return per_name.agg(
        F.coalesce(F.sum("chunks"), F.lit(0)).alias("n_chunks"),
        F.coalesce(F.sum("series"), F.lit(0)).alias("n_series"), F.count("name").alias("n_names"),
    )


def metric_examples(chunks: DataFrame, n: int = 10) -> DataFrame:
    """Sample count and first value of each name's last series, first ``n`` names."""
    example = F.max_by(F.struct((F.col("n_deltas") + 1).alias("n_samples"), "base"), F.struct("path", "doc_no", "key_no"))
    last = _keys(chunks).filter("name is not null").groupBy("name").agg(example.alias("e"))
    top = last.orderBy("name").limit(n)
    return top.select("name", F.col("e.n_samples").alias("n_samples"), F.col("e.base").alias("first_value"))


def metric_names(chunks: DataFrame) -> DataFrame:
    """Distinct names in byte order, numbered from 1."""
    names = _keys(chunks).filter("name is not null").select("name").distinct()
    return number_rows(names, [], ["name"], "name_no").select("name_no", "name")


def import_progress(chunks: DataFrame) -> DataFrame:
    """C4: running chunk and series counts per archive, and the chunk's sample count."""
    rows = chunks.select(
        "path", "doc_no", F.lit(1).cast("bigint").alias("one"), F.col("n_keys_found").alias("found"),
        F.when(F.col("n_keys_found") > 0, F.col("n_deltas") + 1).otherwise(0).alias("n_samples"),
    )
    outs = {"n_chunks": ("sum", "one"), "n_series": ("sum", "found")}
    return running(rows, ["path"], ["doc_no"], outs).select("path", "doc_no", "n_chunks", "n_series", "n_samples")


def axis_audit(chunks: DataFrame) -> DataFrame:
    """Per chunk, steps of the time axis that do not increase, its ends, span and mean step."""
    steps = F.zip_with(F.slice("axis", 2, F.size("axis")), F.slice("axis", 1, F.size("axis") - 1), lambda b, a: b > a)
    rows = chunks.filter(F.size("axis") > 0).select(
        "path", "doc_no", F.size("axis").cast("bigint").alias("n_samples"), F.get("axis", F.lit(0)).alias("first_ms"),
        F.element_at("axis", -1).alias("last_ms"),
        F.when(F.size("axis") > 1, F.size(F.filter(steps, lambda ok: ~ok))).otherwise(0).cast("bigint").alias("n_violations"),
    )
    span = F.col("last_ms") - F.col("first_ms")
    return rows.select("*", span.alias("span_ms"), (span / F.nullif(F.col("n_samples") - 1, F.lit(0).cast("bigint"))).alias("mean_step_ms"))


def shape_audit(chunks: DataFrame) -> DataFrame:
    """Declared and found keys, samples, cells, and whether the declared count fits."""
    return chunks.filter("error is null").select(
        "path", "doc_no", "n_keys", "n_keys_found", (F.col("n_deltas") + 1).alias("n_samples"),
        (F.col("n_keys_found") * F.col("n_deltas")).alias("n_cells"), (F.col("n_keys") == F.col("n_keys_found")).alias("keys_match"),
    )


def verify_samples(chunks: DataFrame, rows: DataFrame) -> DataFrame:
    """C7 after a write: chunks whose stored series or samples are not what was decoded."""
    stored = rows.groupBy("path", "doc_no", "key_no").agg(F.count(F.lit(1)).alias("n")).groupBy("path", "doc_no").agg(
        F.count(F.lit(1)).alias("stored_series"), F.min("n").alias("min_samples"), F.max("n").alias("max_samples")
    )
    wanted = chunks.filter("error is null").select("path", "doc_no", "n_keys_found", (F.col("n_deltas") + 1).alias("n_samples"))
    joined = wanted.join(stored, ["path", "doc_no"], "left")
    same = (F.col("stored_series") == F.col("n_keys_found")) & (F.col("min_samples") == F.col("n_samples")) & (
        F.col("max_samples") == F.col("n_samples"))
    return joined.filter(~F.coalesce(same, F.lit(False)))


def type_distribution(chunks: DataFrame) -> DataFrame:
    """Series per BSON type."""
    return _keys(chunks).filter("name is not null").groupBy("bson_type").agg(F.count(F.lit(1)).alias("n_series"))
