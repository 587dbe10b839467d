"""Work and memory of a task that must not grow with the tables, and sums beyond 64 bits."""

import datetime
import os

import pytest

from diagarc.operators import long_tables
from diagarc.plans.capture import capture_events
from diagarc.plans.catalog import QUERIES
from diagarc.sources.writer import write_archives
from diagarc.streaming.archives import start_table_sink, stream_archives


def events_of(spark, directory, users):
    """A folder with an ``events`` table, one row a minute with these user ids; every fifth is an error."""
    kinds = ("view", "click", "error", "view", "click")
    rows = [(i, datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=i), user, kinds[i % 5], float(i % 7), '{"k": %d}' % (i % 9))
            for i, user in enumerate(users)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{directory}/events.parquet")
    return str(directory)


@pytest.mark.parametrize("query", ["reimport", "write_samples", "delete_series", "delete_labelled_series"])
def test_sums_beyond_64_bits(spark, tmp_path, query):
    users = [2**63 - 1 - i for i in range(20)]
    small, large = events_of(spark, tmp_path / "small", range(20)), events_of(spark, tmp_path / "large", users)
    assert dict(QUERIES[query](spark, small).dtypes)["sum_value"] == "bigint"
    rows = QUERIES[query](spark, large).collect()
    got = {r["name"]: (r["n"], int(r["sum_value"])) for r in rows}
    errors = users[2::5]
    if query in ("reimport", "write_samples"):
        assert got["event_user_id"] == (20, sum(users))
    if query != "write_samples":
        assert got["error"] == (len(errors), sum(errors))


@pytest.mark.parametrize("query", ["zero_run_encode", "expand_zero_runs", "delta_decode"])
def test_more_chunks_are_more_tasks(spark, tmp_path, monkeypatch, query):
    """The windows per chunk are dealt by the cells they unfold into, however few bytes move."""
    directory = events_of(spark, tmp_path, range(2000))
    want = sorted(QUERIES[query](spark, directory).collect())
    monkeypatch.setattr(long_tables, "CELLS_PER_TASK", 600)
    rows = QUERIES[query](spark, directory)
    assert rows.rdd.getNumPartitions() == 20 and sorted(rows.collect()) == want


def test_batches_by_bytes(spark, tmp_path):
    """Small files share a batch that is bounded by bytes; the rows are those of batches of single files."""
    directory, landing = events_of(spark, tmp_path / "tables", range(200)), str(tmp_path / "landing")
    write_archives(capture_events(spark.read.parquet(f"{directory}/events.parquet"), 50), landing, max_docs=1).collect()
    stored, batches = [], []
    for name, bound in (("files", {"max_files": 1}), ("bytes", {"max_bytes": 1 << 20})):
        table, checkpoint = str(tmp_path / name), str(tmp_path / f"{name}-checkpoint")
        start_table_sink(stream_archives(spark, landing + "/*", **bound), table, checkpoint).awaitTermination()
        stored.append(sorted(map(str, spark.read.parquet(table).collect())))
        batches.append(len([f for f in os.listdir(f"{checkpoint}/commits") if f.isdigit()]))
    assert stored[0] == stored[1] and len(stored[0]) == 1200 and batches == [4, 1]


def test_a_batch_is_one_job(spark, tmp_path):
    """However many small files a batch has, no job with a task per file looks them up, and they share tasks."""
    directory, landing = events_of(spark, tmp_path / "tables", range(200)), str(tmp_path / "landing")
    write_archives(capture_events(spark.read.parquet(f"{directory}/events.parquet"), 4), landing, max_docs=1).collect()
    query = start_table_sink(stream_archives(spark, landing + "/*", max_files=40), str(tmp_path / "table"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(str(query.runId))]
    tasks = [tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds]
    assert len(jobs) == 2 and max(tasks) <= 16
    assert spark.read.parquet(str(tmp_path / "table")).count() == 1200
