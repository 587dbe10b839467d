"""Captures built from tables: rows become documents, documents become archives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from diagarc.functions.scalar import int_div, ntz_to_ms
from diagarc.operators.encode import MAX_SAMPLES, chunk_boundaries
from diagarc.operators.flatten import flatten_struct, shape_sign
from diagarc.sources.writer import by_chunk, collect_chunks, pack_chunks


def event_rows(events: DataFrame) -> DataFrame:
    """Events with their source (the calendar day) and time in epoch milliseconds."""
    return events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("path"), ntz_to_ms(F.col("ts")).alias("id_ms"), "event_id", "ts",
        "user_id", "event_type", "value", "props",
    )


def event_document() -> Column:
    """``{start, event: {user_id, value, is_error, props: {k}}, end}`` of an event row."""
    props = F.from_json("props", "k bigint")
    is_error = (F.col("event_type") == "error").alias("is_error")
    event = F.struct("user_id", "value", is_error, props.alias("props"))
    return F.struct(F.col("ts").alias("start"), event.alias("event"), F.col("ts").alias("end"))


def capture(rows: DataFrame, order: list[str], document: Column, max_samples=MAX_SAMPLES) -> DataFrame:
    """Archive documents of rows (path, id_ms, order columns) with one ``document`` each.

    A chunk ends when it is full or when other fields are present than before. Rows are
    numbered as they come and turned into documents afterwards: the ordered numbering then
    moves the small rows with one sign of which fields are present, and the shuffle per chunk only values.
    """
    schema = rows.select(document.alias("document")).schema["document"].dataType
    shaped = rows.withColumn("_layout", shape_sign(document, schema))
    numbered = chunk_boundaries(shaped, ["path"], order, "_layout", max_samples)
    documents = numbered.select("path", "doc_no", "sample_no", "id_ms", F.col("_layout").alias("layout_id"), document.alias("document"))
    return pack_chunks(collect_chunks(flatten_struct(documents, "document").drop("document")))


def capture_events(events: DataFrame, max_samples=MAX_SAMPLES) -> DataFrame:
    return capture(event_rows(events), ["id_ms", "event_id"], event_document(), max_samples)


USERS_PER_SOURCE = 1000
SLOTS = MAX_SAMPLES
HOUR_MS = 3600000


def capture_user_activity(events: DataFrame, slot_ms: int = HOUR_MS) -> DataFrame:
    """Wide captures: one source per 1000 users, one sample per hour, two counters per active user.

    ``{start, u<id>: {n, total}, ..., end}`` with ``n`` events in the slot and ``total``
    since the chunk began. More users give more sources, a longer time more chunks; a
    chunk stays at 300 samples of at most 2002 keys. Events are counted before they move.
    """
    slot = int_div(ntz_to_ms(F.col("ts")), slot_ms)
    counts = events.select(
        F.concat(F.lit("users-"), int_div(F.col("user_id"), USERS_PER_SOURCE).cast("string")).alias("path"), "user_id",
        int_div(slot, SLOTS).alias("doc_no"), (slot % SLOTS).alias("slot"),
    ).groupBy("path", "doc_no", "user_id", "slot").agg(F.count(F.lit(1)).alias("n"))
    # A user has at most 300 slots in a chunk, so this window and list are small.
    w = W.partitionBy("path", "doc_no", "user_id").orderBy("slot").rowsBetween(W.unboundedPreceding, 0)
    per_user = counts.withColumn("total", F.sum("n").over(w)).groupBy("path", "doc_no", "user_id").agg(
        F.array_sort(F.collect_list(F.struct("slot", "n", "total"))).alias("e")
    )
    # Each entry holds until the next one; the count itself only in its own slot.
    stops = F.concat(F.transform(F.slice("e", 2, F.size("e")), lambda x: x["slot"]), F.array(F.lit(SLOTS).cast("bigint")))
    runs = F.zip_with("e", stops, lambda x, stop: F.struct(x["n"], x["total"], (stop - x["slot"]).cast("int").alias("len")))
    zero = F.lit(0).cast("bigint")
    lead = F.array_repeat(zero, F.get("e", F.lit(0))["slot"].cast("int"))
    hourly = F.transform(runs, lambda r: F.concat(F.array(r["n"]), F.array_repeat(zero, r["len"] - 1)))
    totals = F.transform(runs, lambda r: F.array_repeat(r["total"], r["len"]))
    per_user = per_user.select(
        "path", "doc_no", "user_id", F.concat(lead, F.flatten(hourly)).alias("n"), F.concat(lead, F.flatten(totals)).alias("total")
    )
    slots = F.sequence(F.lit(0), F.lit(SLOTS - 1))
    grouped = by_chunk(per_user).groupBy("path", "doc_no").agg(F.array_sort(F.collect_list(F.struct("user_id", "n", "total"))).alias("u"))
    axis = F.transform(slots, lambda s: (F.col("doc_no") * SLOTS + s) * slot_ms)

    def keys(x):
        user = F.concat(F.lit("u"), x["user_id"].cast("string"))
        return F.array(_key(F.array(user, F.lit("n"))), _key(F.array(user, F.lit("total"))))

    def _key(field, bson_type="int64"):
        return F.struct(field.alias("field"), F.lit(bson_type).alias("bson_type"))

    ends = [F.array(_key(F.array(F.lit(name)), "datetime")) for name in ("start", "end")]
    chunks = grouped.select(
        "path", "doc_no", F.get(axis, F.lit(0)).alias("id_ms"),
        F.concat(ends[0], F.flatten(F.transform("u", keys)), ends[1]).alias("layout"),
        F.concat(F.array(axis), F.flatten(F.transform("u", lambda x: F.array(x["n"], x["total"]))), F.array(axis)).alias("series"),
    )
    return pack_chunks(chunks)
