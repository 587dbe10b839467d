"""Send each kind of document to its own handler."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diagarc.plans.shared import run_dir
from diagarc.sources.archives import METADATA, METADATA_DELTA, METRIC, metadata as read_metadata


def stage_docs(docs: DataFrame) -> DataFrame:
    """Documents as a table in the shared folder, partitioned by type: framed once, read per type."""
    spark = docs.sparkSession
    table = run_dir(spark, "docs")
    docs.write.partitionBy("doc_type").parquet(table)
    return spark.read.schema(docs.schema).parquet(table)


def route_docs(docs: DataFrame, metadata=None, metric=None, delta=None, skipped=None, stage=None) -> DataFrame:
    """Union of the handlers' outputs; each handler maps a DataFrame to a DataFrame.

    ``metadata`` gets parsed documents that have a ``doc``, ``skipped`` those of the kind that
    do not (a reader warns about them and goes on), ``metric`` and ``delta`` get whole
    documents. A kind without a handler is left out, so its documents are filtered away right
    after framing. Order by (path, doc_no) to see results in archive order. With two handlers
    or more, documents of their kinds are framed once into a staged table that each reads its
    part of; ``stage=False`` lets every handler read ``docs`` on its own.
    """
    handlers = {METADATA: metadata or skipped, METRIC: metric, METADATA_DELTA: delta}
    kinds = [k for k, h in handlers.items() if h is not None]
    if not kinds:
        raise ValueError("route_docs needs at least one handler")
    if stage or stage is None and len([h for h in (metadata, metric, delta, skipped) if h is not None]) > 1:
        docs = stage_docs(docs.filter(F.col("doc_type").isin(kinds)))
    parts = []
    if handlers[METADATA] is not None:
        own = read_metadata(docs.filter(F.col("doc_type") == METADATA))
        parts += [metadata(own.filter("fields is not null"))] if metadata is not None else []
        parts += [skipped(own.filter("fields is null"))] if skipped is not None else []
    if metric is not None:
        parts.append(metric(docs.filter(F.col("doc_type") == METRIC)))
    if delta is not None:
        parts.append(delta(docs.filter(F.col("doc_type") == METADATA_DELTA)))
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p, allowMissingColumns=True)
    return result
