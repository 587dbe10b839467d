"""Quality scores: the fit against plain formulas, held-out accuracy, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from diagarc.llm import quality

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def grams(text):
    """Different n-grams of a text as strings."""
    data, words = text.encode(), [w for w in text.encode().replace(b"\n", b" ").replace(b"\t", b" ").split(b" ") if w]
    again = [i > 0 and words[i] == words[i - 1] for i in range(len(words))]
    marked = [None if a else w for w, a in zip(words, again)]
    found = {("bytes", data[i : i + n]) for n in range(1, 5) for i in range(len(data) - n + 1)}
    found |= {("word", w) for w in marked} | {("pair", p) for p in zip(marked, marked[1:])}
    return found | {("repeats", tuple(again[i : i + n])) for n in range(2, 6) for i in range(len(again) - n + 1)}


def test_indicators(monkeypatch):
    monkeypatch.setattr(quality, "BUCKETS", 1 << 26)
    for text in ("", "a", "ab ab  ab\ncd", "é. " * 40, "one two three three three four"):
        assert len(quality.indicators(text)) == len(grams(text))
    assert len(quality.indicators(None)) == 0


def test_ratios():
    sets, labels = [np.array([1, 2], np.int32), np.array([2, 3], np.int32), np.array([2], np.int32)], np.array([1, 0, 1])
    got = quality.ratios(sets, labels)
    own = {k: 1 + np.bincount(np.concatenate([s for s, y in zip(sets, labels) if y == k]), minlength=quality.BUCKETS) for k in (0, 1)}
    assert np.allclose(got, np.log(own[1] / own[1].sum() / (own[0] / own[0].sum())))


def test_dual_descent_reaches_the_least_loss():
    """No small step from its answer lowers the primal objective, and primal and dual agree."""
    draw = np.random.default_rng(1)
    rows = [(np.arange(6), draw.normal(size=6)) for _ in range(80)]
    labels = np.array([int(v[0] + 0.5 * v[1] + draw.normal() > 0) for _, v in rows])
    cost = np.full(80, 0.7)
    weights, bias = quality.dual_descent(rows, labels, cost, rounds=3000, least=1e-9)
    x, y = np.stack([v for _, v in rows]), 2 * labels - 1

    def loss(w):
        return (w @ w) / 2 + (cost * np.maximum(0, 1 - y * (x @ w[:6] + w[6]))).sum()

    at = np.append(weights[:6], bias)
    assert all(loss(at) <= loss(at + 1e-3 * draw.normal(size=7)) + 1e-9 for _ in range(500))


def test_curve():
    draw = np.random.default_rng(2)
    margins = draw.normal(size=4000)
    labels = (draw.random(4000) < 1 / (1 + np.exp(-(2 * margins - 0.5)))).astype(int)
    slope, offset = quality.curve(margins, labels, np.ones(4000))
    assert abs(slope - 2) < 0.25 and abs(offset + 0.5) < 0.2


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels")]


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    found = quality.scored(docs, quality.fit(docs, labels)).withColumn("held", quality.held_out()).join(labels, "doc_id").filter("held").collect()
    good, bad = [r.score for r in found if r.quality == 1], [r.score for r in found if r.quality == 0]
    assert np.mean([a > b for a in good for b in bad]) > 0.98 and np.mean([s >= 0.3 for s in good]) > 0.99 and np.mean([s < 0.3 for s in bad]) > 0.7


def test_labels_of_held_out_rows_are_not_read(tables):
    docs, labels = tables
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")).cast("int"))
    one, other = (quality.fit(docs, t) for t in (labels, turned))
    assert all(np.array_equal(a, b) for a, b in zip(one, other))
    renamed = docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit(None).cast("string"))
    assert [r.score for r in quality.scored(renamed, one).orderBy("doc_id").collect()] == [r.score for r in quality.scored(docs, one).orderBy("doc_id").collect()]


def test_odd_rows(spark, tables):
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (3, " \n\t", "en", "a", 3), (None, "no id", "de", "b", 5), (5, "one", "de", "b", 3), (5, "one", "de", "b", 3),
            (7, "very long " * 200_000, "en", "a", 2_000_000)]
    docs = spark.createDataFrame(rows, DOCS)
    for name in ("label", "place", "id", "own", "n", "score", "predicted", "held_out"):
        docs = docs.withColumn(name, F.lit("clash"))
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (7, 1, 0), (1, None, 0), (None, 0, 0), (99, 1, 0), (2, 7, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.fit(*tables)
    got = quality.scored(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1 and len({r.score for r in got if r.doc_id == 5}) == 1
    # Where too little is labelled, or nothing, only shares are known: one good row of three.
    assert {round(r.score, 6) for r in quality.scored(docs, quality.fit(docs, labels)).collect()} == {round((1 + 1) / (3 + 2), 6)}
    assert {r.score for r in quality.scored(docs, quality.fit(docs.limit(0), labels.limit(0))).collect()} == {0.5}
    assert quality.scored(docs.limit(0), model).count() == 0


def test_fewer_indicators(tables):
    """A bound on all indicators takes fewer rows, in the same order."""
    docs, labels = tables
    ratio, weights, _ = quality.fit(docs, labels, most=40_000)
    whole = quality.fit(docs, labels)[0]
    assert 0 < np.count_nonzero(ratio != np.median(ratio)) < np.count_nonzero(whole != np.median(whole))
