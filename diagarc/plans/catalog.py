"""Queries over the given tables, one or more per operator.

Each takes (spark, directory of Parquet tables). The telemetry in them is made of
``events``: every event is one sampled document, every day one source, and a chunk
closes at 300 samples, so any amount of events makes chunks of the same size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from diagarc.errors import decode_errors
from diagarc.functions.scalar import I64_MAX, I64_MIN, clean_key, double_to_i64, int_div, ntz_to_ms
from diagarc.operators import check, encode, labels, long_tables, metadata as meta
from diagarc.operators import store
from diagarc.operators.decode import chunk_keys, chunk_tokens, change_points, decode_chunks, samples, series, value_changes
from diagarc.operators.delivery import chunk_payloads, remote_write, requests_of, write_requests
from diagarc.operators.flatten import explode_fields, flatten_struct, split_timestamp
from diagarc.operators.rollup import rollup
from diagarc.operators.routing import route_docs
from diagarc.plans.capture import capture, capture_events, capture_user_activity, event_document, event_rows
from diagarc.plans.shared import freeze, run_dir
from diagarc.sources import archives
from diagarc.sources.datasource import register
from diagarc.sources.writer import pack_metadata, write_archives
from diagarc.streaming.archives import start_table_sink, stream_archives

SPLIT_SINCE = 1704844800000  # 2024-01-10
HOUR_MS, ODD_WINDOW_MS = 3600000, 6000000  # the second cuts runs between their samples
DOCS_PER_FILE, SAMPLES_PER_DOC = 2, 100  # small, so that a day has several files


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def _docs(spark, d):
    return capture_events(_table(spark, d, "events"))


def _counted_docs(spark, d):
    """Documents, packed once, and the number of tasks for their cells."""
    docs = freeze(_docs(spark, d))
    return docs, long_tables.chunk_tasks(decode_chunks(docs, want="keys"))


def _chunks(spark, d, **options):
    return decode_chunks(_docs(spark, d), **options)


def _samples(spark, d):
    return samples(_chunks(spark, d), with_ts=False)


# --- decode ----------------------------------------------------------------


def archive_samples(spark, d):
    return _samples(spark, d)


def archive_daily_avg(spark, d):
    rows = _samples(spark, d).groupBy("path", "name")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("avg_value"))


def named_samples(spark, d):
    chunks = _chunks(spark, d, names=["event_value", "event_props_k"])
    return samples(chunks, with_ts=False)


def wide_samples(spark, d):
    docs = capture_user_activity(_table(spark, d, "events"))
    rows = samples(decode_chunks(docs), with_ts=False)
    return rows.groupBy("path", "doc_no", "name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("sum_value"), F.max("value").alias("max_value"),
        F.min("ts_ms").alias("first_ms"), F.max("ts_ms").alias("last_ms"),
    )


def sparse_summary(spark, d):
    """Means and extremes from change points alone, without dense rows."""
    rows = value_changes(_chunks(spark, d)).groupBy("path", "doc_no", "name")
    return rows.agg(
        F.sum(F.col("value") * F.col("n_samples")).alias("sum_value"), F.sum("n_samples").cast("bigint").alias("n"),
        F.min("value").alias("min_value"), F.max("value").alias("max_value"), F.count(F.lit(1)).alias("n_runs"),
    )


def rollup_hours(spark, d):
    """Time-weighted hourly means, extremes and last values of every counter."""
    return rollup(_chunks(spark, d), HOUR_MS)


def rollup_wide(spark, d):
    """Hourly counters in windows of 100 minutes, whose borders fall between samples."""
    return rollup(decode_chunks(capture_user_activity(_table(spark, d, "events"))), ODD_WINDOW_MS)


def schema_change_samples(spark, d):
    """Documents without ``k`` for errors: a chunk ends wherever the shape changes."""
    rows = event_rows(_table(spark, d, "events"))
    known = F.when(F.col("event_type") != "error", F.from_json("props", "k bigint")["k"])
    event = F.struct("user_id", F.struct(known.alias("k")).alias("props"))
    docs = capture(rows, ["id_ms", "event_id"], F.struct(F.col("ts").alias("start"), event.alias("event"), F.col("ts").alias("end")))
    return samples(decode_chunks(docs), with_ts=False)


def varint_tokens(spark, d):
    rows = chunk_tokens(_docs(spark, d)).select("path", "doc_no", F.posexplode("tokens").alias("token_no", "token"))
    return rows.withColumn("token_no", F.col("token_no").cast("bigint"))


def decode_chunk_heads(spark, d):
    """Heads of chunks, of which every fourth by its minute declares a wrong size."""
    wrong = int_div(F.col("id_ms"), 60000) % 4 == 1
    body = F.when(wrong, F.overlay("body", F.lit(bytearray(4)), 39)).otherwise(F.col("body"))
    rows = chunk_tokens(_docs(spark, d).withColumn("body", body))
    same = F.col("declared_bytes") == F.col("inflated_bytes")
    return rows.select("path", "doc_no", "id_ms", "n_keys", "n_deltas", "n_keys_found", same.alias("sizes_match"))


def decoded_keys(spark, d):
    rows = chunk_keys(_docs(spark, d)).select(
        "path", "doc_no", "key_no", "name", "bson_type", "base", F.explode_outer("points").alias("p"))
    return rows.select("path", "doc_no", "key_no", "name", "bson_type", "base", "p.sample_no", "p.delta")


def expand_zero_runs(spark, d):
    docs, n = _counted_docs(spark, d)
    return long_tables.expand_zero_runs(long_tables.by_chunk(chunk_tokens(docs), n))


def stream_complete(spark, d):
    """Token streams, of which those of two days in three lack their last token or have one too many."""
    day = F.substring("path", 9, 2).cast("int") % 3
    tokens = (
        F.when(day == 1, F.slice("tokens", F.lit(1), F.greatest(F.size("tokens") - 1, F.lit(0))))
        .when(day == 2, F.concat("tokens", F.array(F.lit(7).cast("bigint")))).otherwise(F.col("tokens"))
    )
    docs, n = _counted_docs(spark, d)
    rows = chunk_tokens(docs).withColumn("tokens", tokens)
    rows = long_tables.stream_complete(long_tables.by_chunk(rows, n))
    return rows.groupBy("path", "error").agg(F.count(F.lit(1)).alias("n_chunks"))


def _decoded_points(spark, d):
    docs, n = _counted_docs(spark, d)
    points = long_tables.by_chunk(change_points(chunk_keys(docs)), n)
    return long_tables.delta_decode(points)


def delta_decode(spark, d):
    return _decoded_points(spark, d).select("path", "doc_no", "key_no", "name", "sample_no", "value")


def densify(spark, d):
    return long_tables.densify(_decoded_points(spark, d))


def time_axis(spark, d):
    return long_tables.time_axis(long_tables.densify(_decoded_points(spark, d)))


def _series_text(rows):
    text = F.array_join(F.transform("values", lambda v: v.cast("string")), ",")
    return rows.select(
        "path", "doc_no", "key_no", "name", F.size("values").cast("bigint").alias("n"), text.alias("value_list"),
        F.array_max("ts_ms").alias("last_ms"))


def series_rows(spark, d):
    return _series_text(series(_chunks(spark, d)))


def series_of_samples(spark, d):
    return _series_text(long_tables.series_of(_samples(spark, d)))


def samples_of_series(spark, d):
    return long_tables.samples_of(series(_chunks(spark, d)))


# --- flatten and scalar ----------------------------------------------------


def flatten_struct_keys(spark, d):
    rows = _table(spark, d, "events").select("event_id", event_document().alias("document"))
    return explode_fields(flatten_struct(rows, "document").drop("document"))


def flatten_array_keys(spark, d):
    """Array positions become path segments: embedding components in thousandths."""
    vectors = _table(spark, d, "embeddings")
    scaled = F.transform("embedding", lambda x: x.cast("double") * 1000)
    rows = vectors.select("vec_id", F.struct(F.struct("label", scaled.alias("e")).alias("vec.data")).alias("document"))
    return explode_fields(flatten_struct(rows, "document").drop("document"))


def clean_key_names(spark, d):
    part = _table(spark, d, "part").select(F.concat(F.lit("  p.("), "p_name", F.lit(")-,"), "p_brand", F.lit("\u3000")).alias("raw"))
    docs = _table(spark, d, "documents").select(F.col("text").alias("raw"))
    urls = _table(spark, d, "pages").select(F.col("url").alias("raw"))
    raw = part.unionByName(docs).unionByName(urls)
    return raw.groupBy(clean_key(F.col("raw")).alias("clean")).agg(F.count(F.lit(1)).alias("n"))


def to_i64(spark, d):
    items = _table(spark, d, "lineitem")
    price, line = F.col("l_extendedprice"), F.col("l_linenumber")
    v = (
        F.when(line == 1, F.lit(float("nan"))).when(line == 2, F.lit(1e30)).when(line == 3, F.lit(-1e30))
        .when(line == 4, -price).otherwise(price)
    )
    return items.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", double_to_i64(v).alias("v"))


def split_timestamps(spark, d):
    ms = ntz_to_ms(F.col("ts"))
    events, parts = _table(spark, d, "events"), (int_div(ms, 1000), F.col("user_id"))
    rows = events.select("event_id", split_timestamp(F.lit("oplog"), *parts, spec_bases=True).alias("m"))
    rows = rows.unionByName(events.select("event_id", split_timestamp(F.lit("stored"), *parts).alias("m")))
    return rows.select("event_id", F.col("m.name").alias("name"), F.col("m.value").alias("value"))


# --- encode ----------------------------------------------------------------


def _event_numbers(spark, d):
    return _table(spark, d, "events").select(
        "event_type", ntz_to_ms(F.col("ts")).alias("ms"), "event_id", "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def delta_encode(spark, d):
    rows = long_tables.delta_encode(_event_numbers(spark, d), ["event_type"], ["ms", "event_id"], "user_id")
    return rows.select("event_type", "event_id", "user_id", "delta")


def _chunk_cells(spark, d):
    docs, n = _counted_docs(spark, d)
    rows = long_tables.delta_encode(
        long_tables.by_chunk(samples(decode_chunks(docs), with_ts=False), n), ["path", "doc_no", "key_no"], ["sample_no"], bounded=True)
    return long_tables.cells(rows.filter("delta is not null"), ["key_no", "sample_no"])


def zero_run_encode(spark, d):
    return long_tables.zero_run_encode(_chunk_cells(spark, d))


def varint_size(spark, d):
    return encode.token_sizes(long_tables.zero_run_encode(_chunk_cells(spark, d)), ["path"])


def chunk_boundaries(spark, d):
    rows = _event_numbers(spark, d).withColumn("source", F.col("user_id") % 3)
    cut = encode.chunk_boundaries(rows, ["source"], ["ms", "event_id"], "event_type", max_samples=2)
    return cut.select("source", "event_id", "doc_no", "sample_no")


# --- archives as files -----------------------------------------------------


def _archive_dir(spark, d):
    """Archives of all events, in a new folder of the shared directory."""
    directory = run_dir(spark, "archives")
    docs = capture_events(_table(spark, d, "events"), SAMPLES_PER_DOC)
    write_archives(docs, directory, max_docs=DOCS_PER_FILE).write.format("noop").mode("overwrite").save()
    return directory


def _file_docs(spark, d):
    return archives.read_archives(spark, _archive_dir(spark, d) + "/*")


def _day_and_file(path="path"):
    return F.regexp_extract(path, r"([^/]+)/metrics\.", 1).alias("day"), F.regexp_extract(path, r"Z-(\d+)$", 1).cast("bigint").alias("file_no")


def read_archives(spark, d):
    docs = _file_docs(spark, d)
    return docs.select(*_day_and_file(), "doc_no", "doc_type", "id_ms", (F.col("byte_offset") == 0).alias("is_first"))


def file_samples(spark, d):
    rows = samples(decode_chunks(_file_docs(spark, d)), with_ts=False)
    return rows.select(*_day_and_file(), "doc_no", "key_no", "name", "sample_no", "ts_ms", "value")


def split_archive_samples(spark, d):
    """Files cut into small ranges; type and time are filters that the source takes over."""
    register(spark)
    docs = spark.read.format("diagarc").option("splitBytes", 4096).load(_archive_dir(spark, d))
    docs = docs.filter((F.col("doc_type") == archives.METRIC) & (F.col("id_ms") >= SPLIT_SINCE))
    rows = samples(decode_chunks(docs), with_ts=False)
    return rows.select(*_day_and_file(), "key_no", "name", "sample_no", "ts_ms", "value")


def growing_archive_samples(spark, d):
    """The same files as a stream by bytes, in batches of bounded size, into a table."""
    register(spark)
    table, checkpoint = run_dir(spark, "table"), run_dir(spark, "stream")
    docs = spark.readStream.format("diagarc").option("splitBytes", 65536).load(_archive_dir(spark, d))
    start_table_sink(docs, table, checkpoint).awaitTermination()
    rows = spark.read.parquet(table)
    return rows.select(*_day_and_file(), "key_no", "name", "sample_no", "ts_ms", "value")


def archive_file_time(spark, d):
    start, number = archives.archive_file_time("path")
    files = archives.list_archives(spark, _archive_dir(spark, d) + "/*", since="2024-01-10 00:00:00")
    return files.select(_day_and_file()[0], ntz_to_ms(start).alias("file_ms"), number.cast("bigint").alias("uniquifier"))


def first_metric_docs(spark, d):
    rows = archives.first_metric_docs(_file_docs(spark, d))
    json_ms = F.get_json_object("json", "$._id['$date']['$numberLong']").cast("bigint")
    return rows.select(*_day_and_file(), "doc_no", "id_ms", json_ms.alias("json_ms"))


def metric_docs(spark, d):
    docs = archives.metric_docs(_mixed_docs(spark, d))
    return docs.groupBy("path").agg(F.count(F.lit(1)).alias("n_docs"), F.min("id_ms").alias("first_ms"))


def doc_outline(spark, d):
    return archives.doc_outline(_docs(spark, d)).select("path", "doc_no", "ord", "depth", "key", "type", "preview")


def _mixed_docs(spark, d):
    """Metric documents of each day and, per user, metadata documents and deltas."""
    metric = _docs(spark, d)
    user = F.concat(F.lit("user-"), F.col("user_id").cast("string"))
    deltas = _user_deltas(spark, d).withColumn("path", user)
    packed = pack_metadata(deltas.select(
        "path", F.col("event_id").alias("doc_no"), "doc_type", F.col("ms").alias("id_ms"),
        F.when(F.col("doc_type") == archives.METADATA_DELTA, F.col("index")).alias("index"), "fields"))
    return metric.unionByName(packed)


def doc_types(spark, d):
    docs = _mixed_docs(spark, d)
    return docs.groupBy("doc_type").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id_ms").alias("last_ms"))


def route_docs_by_kind(spark, d):
    def kind(name):
        return lambda docs: docs.select(F.lit(name).alias("kind"), "path", "doc_no")

    routed = route_docs(_mixed_docs(spark, d), metadata=kind("metadata"), metric=kind("metric"), delta=kind("delta"))
    return routed.groupBy("kind").agg(F.count(F.lit(1)).alias("n_docs"), F.countDistinct("path").alias("n_paths"))


def _damaged(spark, d):
    """Documents with one of three kinds of damage, by their number."""
    body, size = F.col("body"), F.length("body")
    damage = (
        F.when(F.col("doc_no") % 4 == 1, F.substring(body, F.lit(1), size - 5))
        .when(F.col("doc_no") % 4 == 2, F.overlay(body, F.lit("tipe").cast("binary"), 19))
        .when(F.col("doc_no") % 4 == 3, F.overlay(body, F.lit("dada").cast("binary"), 29))
        .otherwise(body)
    )
    return _docs(spark, d).withColumn("doc_no", int_div(F.col("id_ms"), 60000)).withColumn("body", damage)


def decode_error_classes(spark, d):
    """What the decoder says about each damaged document, counted."""
    return decode_errors(decode_chunks(_damaged(spark, d), mode="permissive"))


def damaged_import(spark, d):
    """A permissive import of damaged documents: what is stored, what is counted and what is listed."""
    table = run_dir(spark, "damaged")
    totals = store.import_archives(_damaged(spark, d), table, mode="permissive")
    counted = spark.createDataFrame([("n_chunks", totals["n_chunks"]), ("n_errors", totals["n_errors"])], "kind string, n bigint")
    stored = store.read_table(spark, table, "series").groupBy(F.concat(F.lit("stored "), "name").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    listed = spark.read.schema("error_class string").parquet(table + "/_errors").groupBy(F.col("error_class").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return counted.unionByName(stored).unionByName(listed)


def stream_archive_samples(spark, d):
    """Archives arrive as files, the stream decodes them into a table, the table is read."""
    landing, table, checkpoint = _archive_dir(spark, d), run_dir(spark, "table"), run_dir(spark, "stream")
    docs = stream_archives(spark, landing + "/*", max_files=50)
    start_table_sink(docs, table, checkpoint).awaitTermination()
    rows = spark.read.parquet(table)
    return rows.select(*_day_and_file(), "doc_no", "key_no", "name", "sample_no", "ts_ms", "value", F.col("date").cast("string").alias("date"))


# --- labels, requests, tables ----------------------------------------------


def parse_labels(spark, d):
    events = _table(spark, d, "events")
    forms = F.array(
        F.concat(F.lit(" "), "event_type", F.lit(" =\t"), "props"), F.concat("event_type", F.lit("=a=b=")), F.col("props"),
        F.concat(F.lit(" = "), "props"), F.concat("event_type", F.lit("=")))
    raw = events.select(F.explode(forms).alias("raw")).unionByName(
        _table(spark, d, "documents").select(F.concat("source", F.lit(" = "), "text").alias("raw")))
    rows = labels.parse_labels(raw, "raw")
    return rows.groupBy("label_name", "label_value", "reason").agg(F.count(F.lit(1)).alias("n"))


def with_labels(spark, d):
    rows = labels.with_labels(check._keys(_chunks(spark, d, want="keys")), [("host", "a=1"), ("host", "b")])
    return rows.select("path", "doc_no", "key_no", F.posexplode("labels").alias("label_no", "l")).select(
        "path", "doc_no", "key_no", "label_no", F.col("l.name").alias("label"), F.col("l.value").alias("value"))


def _request_rows(requests):
    t = F.col("t")
    rows = requests.select("path", "doc_no", F.posexplode("timeseries").alias("key_no", "t"))
    text = F.array_join(F.transform(t["labels"], lambda x: F.concat(x["name"], F.lit("="), x["value"])), ",")
    total = F.aggregate(t["samples"], F.lit(0.0), lambda a, s: a + s["value"])
    times = F.transform(t["samples"], lambda s: s["timestamp"])
    return rows.select(
        "path", "doc_no", "key_no", text.alias("labels"), F.size(t["samples"]).cast("bigint").alias("n"),
        total.alias("sum_value"), F.get(times, F.lit(0)).alias("first_ms"), F.element_at(times, -1).alias("last_ms"))


def write_request_rows(spark, d):
    return _request_rows(write_requests(_chunks(spark, d), [("host", "h1")]))


def requests_of_series(spark, d):
    return _request_rows(requests_of(series(_chunks(spark, d)), [("host", "h1")]))


def remote_write_receipts(spark, d):
    def send(url, headers, payload):
        return (204, "") if payload and url.endswith("/api/v1/write") else (500, "empty")

    return remote_write(chunk_payloads(_chunks(spark, d)), "http://collector", send).select(
        "path", "doc_no", "n_series", "n_plain_bytes", "status")


def _value_totals(stored, *by):
    """Rows and sum of values per group. The sums are added up beyond 64 bits and are decimals where one does not fit into a bigint."""
    totals = freeze(stored.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(19,0)")).alias("sum_value")))
    if totals.filter(~F.col("sum_value").between(F.lit(I64_MIN), F.lit(I64_MAX))).isEmpty():
        return totals.withColumn("sum_value", F.col("sum_value").cast("bigint"))
    return totals


def write_samples(spark, d):
    table = run_dir(spark, "samples")
    store.write_samples(store.storable(_samples(spark, d), [("env", "test")]), table, rebalance=True)
    return _value_totals(spark.read.parquet(table), "source", F.col("date").cast("string").alias("date"), "name")


def write_series(spark, d):
    """Stored as one row per metric and chunk, read back as samples."""
    table = run_dir(spark, "series")
    store.import_archives(_docs(spark, d), table, layout="series")
    return long_tables.samples_of(spark.read.parquet(table))


def _labelled_table(spark, d):
    """Stored samples of two sources: imports, and rows of another origin."""
    rows = _event_numbers(spark, d)
    source = F.when(F.col("event_type") == "error", F.lit("other")).otherwise(labels.SOURCE_LABEL[1])
    pair = F.struct(F.lit("type").alias("name"), F.col("event_type").alias("value"))
    table = run_dir(spark, "labelled")
    store.write_samples(rows.select(
        F.lit("events").alias("path"), F.lit(0).cast("bigint").alias("doc_no"), F.lit(0).alias("key_no"),
        F.col("event_type").alias("name"), F.lit(0).alias("sample_no"), F.col("ms").alias("ts_ms"), F.col("user_id").alias("value"),
        F.array(pair).alias("extra_labels"), source.alias("source"), F.lit("2024-01-01").cast("date").alias("date")), table)
    return table


def delete_series(spark, d):
    left = store.delete_series(spark.read.parquet(_labelled_table(spark, d)))
    return _value_totals(left, "source", "name")


def delete_labelled_series(spark, d):
    left = store.delete_series(spark.read.parquet(_labelled_table(spark, d)), {"source": labels.SOURCE_LABEL[1], "type": "click"})
    return _value_totals(left, "source", "name")


def reimport(spark, d):
    table = run_dir(spark, "reimported")
    store.reimport(spark, _docs(spark, d), _labelled_table(spark, d), table, clean=True, layout="samples")
    return _value_totals(store.read_table(spark, table), "source", "name")


def import_summary(spark, d):
    totals = store.import_archives(_docs(spark, d), run_dir(spark, "summary"))
    return spark.createDataFrame([(totals["n_chunks"], totals["n_series"])], "n_chunks bigint, n_series bigint")


# --- check -----------------------------------------------------------------


def check_totals(spark, d):
    return check.check_totals(_chunks(spark, d, want="keys"))


def metric_examples(spark, d):
    return check.metric_examples(_chunks(spark, d, want="keys"), 10)


def metric_names(spark, d):
    return check.metric_names(decode_chunks(capture_user_activity(_table(spark, d, "events")), want="keys"))


def import_progress(spark, d):
    return check.import_progress(_chunks(spark, d, want="keys"))


def type_distribution(spark, d):
    return check.type_distribution(_chunks(spark, d, want="keys"))


def axis_audit(spark, d):
    """Chunks sampled out of order, so that their axes go back at times."""
    rows = event_rows(_table(spark, d, "events")).withColumn("turn", F.col("event_id") % 7)
    docs = capture(rows, ["turn", "event_id"], event_document())
    return check.axis_audit(decode_chunks(docs, names=[]))


def shape_audit(spark, d):
    return check.shape_audit(_chunks(spark, d, want="keys"))


def verify_stored(spark, d):
    """Chunks whose stored samples differ from what was decoded, after dropping one metric of a day."""
    chunks = _chunks(spark, d)
    stored = samples(chunks, with_ts=False).filter("not (path = '2024-01-05' and name = 'end')")
    return check.verify_samples(chunks, stored).select("path", "doc_no", "n_keys_found", "stored_series")


# --- metadata --------------------------------------------------------------


def _user_documents(spark, d):
    """A metadata document per event of a user; every tenth value of k adds a field."""
    rows = _event_numbers(spark, d)

    def field(name, value):
        return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))

    usual = F.array(
        field("start", F.col("ms")), field("type", F.col("event_type")), field("half", int_div(F.col("k"), 50)),
        field("end", F.col("ms") + 1))
    extra = F.when(F.col("k") % 10 == 0, F.array(field("tag", F.lit("x")))).otherwise(F.array().cast("array<struct<name:string,value:string>>"))
    return rows.select("user_id", "ms", "event_id", F.concat(usual, extra).alias("fields"))


def _user_deltas(spark, d):
    return meta.metadata_delta(_user_documents(spark, d), ["user_id"], ["ms", "event_id"])


def metadata_delta(spark, d):
    text = F.array_join(F.transform("fields", lambda f: F.concat(f["name"], F.lit("="), f["value"])), ",")
    return _user_deltas(spark, d).select("user_id", "event_id", "doc_type", "index", text.alias("fields"))


AS_OF_MS = 1705276800000  # 2024-01-15, mid-way through the events


def metadata_as_of(spark, d):
    return meta.metadata_as_of(_user_deltas(spark, d), ["user_id"], ["ms", "event_id"], AS_OF_MS)


def metadata_as_of_archive(spark, d):
    """The same from archive documents: packed, read back, replayed."""
    fields = archives.metadata(_mixed_docs(spark, d)).filter("fields is not null")
    rows = meta.metadata_as_of(fields, ["path"], ["id_ms", "doc_no"], AS_OF_MS)
    return rows.select("path", "name", F.from_json(F.concat(F.lit('{"v":'), "value", F.lit("}")), "v string")["v"].alias("value"))


def metadata_history(spark, d):
    return meta.metadata_history(_user_deltas(spark, d), ["user_id"], ["ms", "event_id"], ["type", "half", "tag"]).select(
        "user_id", "event_id", "type", "half", "tag")


QUERIES = {
    f.__name__: f
    for f in (
        archive_samples, archive_daily_avg, named_samples, wide_samples, sparse_summary, rollup_hours, rollup_wide, schema_change_samples, varint_tokens,
        decode_chunk_heads, decoded_keys, expand_zero_runs, stream_complete, delta_decode, densify, time_axis,
        series_rows, series_of_samples, samples_of_series, flatten_struct_keys, flatten_array_keys, clean_key_names,
        to_i64, split_timestamps, delta_encode, zero_run_encode, varint_size, chunk_boundaries, read_archives,
        file_samples, split_archive_samples, growing_archive_samples, archive_file_time, first_metric_docs, metric_docs, doc_outline, doc_types, route_docs_by_kind,
        decode_error_classes, damaged_import, stream_archive_samples, parse_labels, with_labels, write_request_rows,
        requests_of_series, remote_write_receipts, write_samples, write_series, delete_series, delete_labelled_series, reimport,
        import_summary, check_totals, metric_examples, metric_names, import_progress, type_distribution, axis_audit,
        shape_audit, verify_stored, metadata_delta, metadata_as_of, metadata_as_of_archive, metadata_history,
    )
}
