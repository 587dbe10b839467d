"""The data source against whole-file reading: splits, filters, growing files."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from diagarc.sources import datasource
from diagarc.sources.archives import read_archives
from diagarc.sources.writer import write_archives

COLUMNS = ["path", "byte_offset", "doc_type", "id_ms", "body", "error"]


@pytest.fixture(scope="module")
def landing(spark, event_docs, tmp_path_factory):
    datasource.register(spark)
    directory = str(tmp_path_factory.mktemp("archives"))
    write_archives(event_docs, directory, max_docs=20).collect()
    return directory


def rows(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()))


@pytest.mark.parametrize("split", [50, 700, 1 << 25])
def test_splits_read_every_document_once(spark, landing, split):
    df = spark.read.format("diagarc").option("splitBytes", split).load(landing + "/*")
    assert rows(df) == rows(read_archives(spark, landing + "/*"))
    if split == 700:
        assert df.rdd.getNumPartitions() > len(glob.glob(landing + "/*/*"))


def test_files_by_name_time_and_glob(spark, landing):
    docs = read_archives(spark, landing + "/*", since="2024-01-02 00:00:00", until="2024-01-04 00:00:00")
    df = spark.read.format("diagarc").option("since", "2024-01-02 00:00:00").option("until", "2024-01-04 00:00:00").load(landing)
    assert rows(df) == rows(docs) and docs.count()
    one = sorted(glob.glob(landing + "/*/*"))[0]
    assert {r.path for r in spark.read.format("diagarc").load(one).collect()} == {"file:" + one}
    assert spark.read.format("diagarc").load(landing + "/none").count() == 0


def test_filters_are_taken_over(spark, landing, monkeypatch):
    whole = read_archives(spark, landing + "/*")
    middle = whole.agg(F.percentile_approx("id_ms", 0.5)).first()[0]
    path = sorted(glob.glob(landing + "/*/*"))[1]
    for condition in (f"id_ms >= {middle}", f"id_ms < {middle} and doc_type = 1", "doc_type in (0, 2)", f"path = 'file:{path}'", f"path like 'file:{os.path.dirname(path)}/%'"):
        got = spark.read.format("diagarc").option("splitBytes", 900).load(landing).filter(condition)
        assert rows(got) == rows(whole.filter(condition))
    reader = datasource.ArchiveReader({"path": landing})
    left = list(reader.pushFilters([datasource.EqualTo(("path",), "file:" + path), datasource.EqualTo(("doc_type",), 1), datasource.EqualTo(("body",), b"")]))
    assert [f.attribute for f in left] == [("body",)] and {p.path for p in reader.partitions()} == {"file:" + path}
    # Bytes of documents that the filters exclude are not read.
    reader, read = datasource.ArchiveReader({"path": path}), []
    at = datasource._File.at
    monkeypatch.setattr(datasource._File, "at", lambda self, pos, n: read.append(n) or at(self, pos, n))
    list(reader.pushFilters([datasource.EqualTo(("doc_type",), 2)]))
    assert not [b for p in reader.partitions() for b in reader.read(p)] and max(read) <= datasource._HEAD_BYTES


def test_damage_ends_a_range_only(spark, landing, tmp_path):
    source = sorted(glob.glob(landing + "/*/*"))[0]
    data = open(source, "rb").read()
    name = os.path.basename(source)
    (tmp_path / name).write_bytes(data[:-3])
    df = spark.read.format("diagarc").load(str(tmp_path))
    assert rows(df) == rows(read_archives(spark, str(tmp_path), mode="permissive"))
    assert df.filter("error like 'truncated_document%'").count() == 1 and df.filter("doc_type = 1 and error is not null").count() == 0


def test_ranges_without_heads(tmp_path):
    """A head inside a document is no beginning unless another document follows where it says."""
    path = tmp_path / "metrics.2024-01-01T00-00-00Z-00000"
    head = b"\x09_id\x00" + b"\1" * 8 + b"\x10type\x00\0\0\0\0"
    false = b"\x30\0\0\0" + head
    body = head + b"\x05doc\x00" + len(false).to_bytes(4, "little") + b"\0" + false + b"\0"
    doc = (len(body) + 4).to_bytes(4, "little") + body
    path.write_bytes(doc * 3)
    for split in (1, 7, 40, 41, 1000):
        parts = datasource.ranges_of("file:" + str(path), 0, 3 * len(doc), split)
        assert sorted(x for p in parts for b in datasource.read_range(p) for x in b.column("byte_offset").to_pylist()) == [0, len(doc), 2 * len(doc)]


def test_growing_files(spark, landing, tmp_path):
    """A file that is appended in steps, cut inside documents, gives each document once, also after a restart."""
    source = max(glob.glob(landing + "/*/*"), key=os.path.getsize)
    data, target = open(source, "rb").read(), tmp_path / "in" / os.path.basename(source)
    target.parent.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    seen = []
    for stop in (len(data) // 3, len(data) // 3 + 2, 2 * len(data) // 3, len(data)):
        with open(target, "ab") as f:
            f.write(data[target.stat().st_size if target.exists() else 0 : stop])
        stream = spark.readStream.format("diagarc").option("splitBytes", 600).load(str(target.parent))
        query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", out).trigger(once=True).start()
        query.awaitTermination()
        seen.append(spark.read.schema(stream.schema).parquet(out).count())
    stored = spark.read.parquet(out)
    want = spark.read.format("diagarc").load(str(target.parent))
    assert rows(stored) == rows(want) and seen[0] == seen[1] <= seen[2] < seen[3] and stored.filter("error is not null").count() == 0


def test_bounded_batches_and_replaced_files(landing, tmp_path):
    reader = datasource.GrowingReader({"path": landing, "maxbytespertrigger": "1"})
    offsets, last = [], None
    while (now := reader.latestOffset()) != last:
        offsets.append(now)
        last = now
    assert len(offsets) > 2 and last == datasource.GrowingReader({"path": landing}).latestOffset() == dict(datasource.list_files({"path": landing}))
    source = sorted(glob.glob(landing + "/*/*"))[0]
    target = tmp_path / os.path.basename(source)
    target.write_bytes(open(source, "rb").read())
    reader = datasource.GrowingReader({"path": str(tmp_path)})
    reader.latestOffset()
    target.write_bytes(b"1234")
    with pytest.raises(ValueError, match="replaced"):
        reader.latestOffset()


def test_small_ranges_share_tasks():
    """Thousands of small files are far fewer tasks, each range still in one of them; long ranges have tasks of their own."""
    files = {f"file:/x/{i:05d}": 6000 for i in range(20000)}
    parts = datasource.GrowingReader({"path": "/none", "splitbytes": "4096"}).partitions({}, files)
    dealt = [(r.path, r.start, r.stop) for p in parts for r in (p, *p.then)]
    assert 256 <= len(parts) < 1000 and dealt == [(f, a, b) for f in sorted(files) for a, b in ((0, 4096), (4096, 6000))]
    assert len(datasource.GrowingReader({"path": "/none"}).partitions({}, {"file:/x/a": 320 << 20})) == 10
