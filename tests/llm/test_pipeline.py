"""The pipeline's stages, each judged on its own input."""

import collections
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """Rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_columns(kept):
    assert all(df.columns == kept[0].columns for df in kept[:5])


def test_language_keeps_documents(kept):
    lost = {r.doc_id for r in kept[0].collect()} - {r.doc_id for r in kept[1].collect()}
    assert all(not re.search("[^\\W\\d_]{3}", r.text or "") for r in kept[0].collect() if r.doc_id in lost)


def test_one_of_each_group(kept):
    from test_text import alike

    rows = [(r.doc_id, r.text) for r in kept[1].collect()]
    assert sorted(r.doc_id for r in kept[2].collect()) == sorted({g for _, _, g in alike(rows, corpus_pipeline.WIDTH, corpus_pipeline.LEAST)})


def test_one_row_of_repeated_ones(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text), (1, text), (2, text), (3, "other words are here in this one"), (3, "and a different text under the same id"), (4, None), (4, None), (None, text + "!")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'en' as lang", "'s' as source", "1L as n_chars")
    left = corpus_pipeline.one_of_each_group(spark, docs, SMALL).collect()
    assert collections.Counter((r.doc_id, r.text) for r in left) == collections.Counter(
        [(1, text), (3, rows[3][1]), (3, rows[4][1]), (4, None), (4, None), (None, text + "!")])


def test_near_copies_at_the_stage_threshold(spark):
    words = [f"w{i}" for i in range(50)]
    texts = [words, [*words[:25], "other", *words[26:]], [*words[:12], "other", *words[13:37], "more", *words[38:]]]
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted(r.doc_id for r in corpus_pipeline.one_of_each_group(spark, docs, SMALL).collect()) == [0, 2]


def test_secrets_are_gone(kept):
    before, after = ({r.doc_id: r for r in df.collect()} for df in kept[2:4])
    assert before.keys() == after.keys()
    assert all(len(r.text) == r.n_chars for r in after.values())
    from test_text import base

    assert not [r for r in after.values() if base(r.text)]
    assert all(after[d].text == r.text for d, r in before.items() if not re.search(r"[A-Za-z0-9+/_=-]{16}|[=:]", r.text))


def test_mix_is_near_its_targets(kept):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    before = {r.doc_id: r for r in kept[3].collect()}
    copies = collections.Counter(r.doc_id for r in kept[4].collect())
    assert max(copies.values()) <= 2
    total = sum(words(r.text) for r in before.values())
    assert abs(sum(n * words(before[d].text) for d, n in copies.items()) - 1.5 * total) < 0.1 * total


def test_mix_without_words(spark):
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, " \n", "en", "t", 2), (4, "some words are here", "en", "s", 19)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert {r.doc_id for r in corpus_pipeline.to_mix(spark, docs, SMALL).collect()} == {4}


def test_sequences(kept):
    places = collections.defaultdict(list)
    for r in kept[5].collect():
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024


def test_run_and_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, SMALL).count() > 0
    spark.read.parquet(f"{SMALL}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


CLASHES = ("row", "id", "hash", "text_hash", "score", "lang_pred", "findings", "changed", "copies", "copy", "times", "head", "head_hash", "taken", "size", "_id", "_rows", "_hash", "_copies", "has space", "a.b")


def test_stages_keep_columns_of_any_name(spark):
    """Values of further columns come through every stage as they are."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    for i, name in enumerate(CLASHES):
        docs = docs.withColumn(name, F.concat(F.lit(f"{i}:"), F.col("doc_id").cast("string")))
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[c] == f"{i}:{r['doc_id']}" for r in rows for i, c in enumerate(CLASHES)) and {r["doc_id"] for r in rows} <= before.keys()
