"""Quality scores by naive Bayes support vectors.

A text is the set of its n-grams: runs of one to four bytes; words and pairs of words, where a word
that repeats the one before it is one and the same sign; and runs of two to five words seen only as
repeating or not, so that stuttering looks alike in every language. Each n-gram is a hashed indicator, scaled by its log-count ratio between the two
classes; vectors are brought to length one. A linear function with hinge loss is fitted to them by
dual coordinate descent, and a logistic curve, fitted to labelled texts that took no part in that,
turns margins into scores.

The model learns from a bounded sample of labelled rows; every row is scored, whole, where it lies.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diagarc.llm.common import map_batches, staged, table
from diagarc.llm.repeats import _sums
from diagarc.llm.sketches import _mixed

#: Indicators that n-grams are hashed to.
BUCKETS = 1 << 18
BYTES, REPEATS = 4, 5
#: The most labelled rows of each class that the model learns from, and the most indicators of all of them.
SAMPLE, INDICATORS = 3000, 1 << 24
#: One in so many of these rows serves the curve alone.
APART = 5
#: Score from which a row is predicted to be good.
GOOD = 0.3
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def indicators(text: str | None) -> np.ndarray:
    """Sorted numbers of the indicators that a text sets; none for null and empty."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    if not len(data):
        return np.zeros(0, np.int32)
    seen, codes = np.zeros(BUCKETS, bool), np.zeros(len(data), np.uint64)

    def add(grams: np.ndarray, kind: int) -> None:
        seen[_mixed(grams + np.uint64(kind << 40)) & np.uint64(BUCKETS - 1)] = True

    for n in range(1, min(BYTES, len(data)) + 1):
        codes = (codes[: len(data) - n + 1] << np.uint64(8)) | data[n - 1 :]
        add(codes, n)
    word = np.concatenate([[False], ~_SPACE[data], [False]])
    edges = np.flatnonzero(word[1:] != word[:-1])
    if len(edges):
        sums, down = _sums(data)
        words = _mixed((sums[edges[1::2]] - sums[edges[::2]]) * down[edges[::2]])
        again = np.append(False, words[1:] == words[:-1])
        words[again] = 1
        add(words, 0)
        add(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:], 0)
        for n in range(2, min(REPEATS, len(words)) + 1):
            add((np.lib.stride_tricks.sliding_window_view(again, n) @ (1 << np.arange(n))).astype(np.uint64), 256 * n)
    return np.flatnonzero(seen).astype(np.int32)


def ratios(sets: list[np.ndarray], labels: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Log of the shares that each indicator has among the indicators of the two classes."""
    counts = [smooth + np.bincount(np.concatenate([s for s, y in zip(sets, labels) if y == k] or [np.zeros(0, np.int32)]), minlength=BUCKETS) for k in (0, 1)]
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def scaled(own: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """The values of a text's indicators, of length one together."""
    values = ratio[own]
    return values / max(np.sqrt(values @ values), 1e-12)


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, cost: np.ndarray, rounds: int = 15, least: float = 1e-2) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise half their square and the hinge losses times ``cost`` per row.

    One dual variable at a time is moved to its best value between 0 and its cost, rows in a new
    order each round, until no projected gradient of a round is above ``least`` or rounds end.
    """
    weights, bias, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(rows))
    sign = np.where(labels == 1, 1.0, -1.0)
    square = np.array([v @ v + 1.0 for _, v in rows])
    draw = np.random.default_rng(7)
    for _ in range(rounds):
        worst = 0.0
        for i in draw.permutation(len(rows)):
            own, values = rows[i]
            gradient = sign[i] * (weights[own] @ values + bias) - 1
            projected = min(gradient, 0) if alpha[i] == 0 else max(gradient, 0) if alpha[i] == cost[i] else gradient
            if projected:
                worst = max(worst, abs(projected))
                moved = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
                step = (moved - alpha[i]) * sign[i]
                alpha[i] = moved
                weights[own] += step * values
                bias += step
        if worst <= least:
            break
    return weights, bias


def curve(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of least weighted loss, by Newton steps with a small ridge."""
    x = np.stack([margins, np.ones(len(margins))], 1)
    target = np.where(labels == 1, 1 - 1 / (2 + labels.sum()), 1 / (2 + (labels == 0).sum()))
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        gradient = x.T @ (weights * (p - target)) + 1e-3 * at
        step = np.linalg.solve(x.T @ (x * (weights * p * (1 - p))[:, None]) + 1e-3 * np.eye(2), gradient)
        at -= np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    return float(max(at[0], 1e-6)), float(at[1])


def train(sets: list[np.ndarray], labels: np.ndarray, apart: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Ratio and weight per indicator and bias, as ``score`` takes them; ``share`` is that of good rows among all labelled ones."""
    one_class = not len(labels) or labels.min() == labels.max() or len(set(labels[~apart])) < 2 or len(set(labels[apart])) < 2
    if one_class:
        given = (labels.sum() + 1) / (len(labels) + 2)
        return np.zeros(BUCKETS), np.zeros(BUCKETS), float(np.log(given / (1 - given)))
    own = [s for s, a in zip(sets, apart) if not a]
    marks = labels[~apart]
    ratio = ratios(own, marks)
    rows = [(s, scaled(s, ratio)) for s in own]
    even = np.where(marks == 1, len(marks) / (2 * marks.sum()), len(marks) / (2 * (marks == 0).sum()))
    weights, bias = dual_descent(rows, marks, 4.0 * even)
    rest, left = [s for s, a in zip(sets, apart) if a], labels[apart]
    margins = np.array([weights[s] @ scaled(s, ratio) + bias for s in rest])
    true = np.where(left == 1, share / left.mean(), (1 - share) / (1 - left.mean()))
    slope, offset = curve(margins, left, true)
    return ratio, weights * slope, bias * slope + offset


def score(text: str | None, model) -> float:
    """Probability that a text is good; that of a text without n-grams where text is null or empty."""
    ratio, weights, bias = model
    own = indicators(text)
    return float(1 / (1 + np.exp(-np.clip(weights[own] @ scaled(own, ratio) + bias, -30, 30))))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = INDICATORS):
    """A model from labelled rows that are not held out.

    Of each class the ``sample`` ids that come first by hash are taken, and of these rows as many,
    in that order, as have ``most`` indicators together, so what reaches the driver is bounded.
    Labels other than 0 and 1 and ids without a document are ignored; of several labels of an id the
    smallest counts. Without both classes every score is their smoothed share (a half if none).
    """
    marks = labels.filter("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    marks = marks.filter(~held_out()).withColumn("place", F.xxhash64("doc_id"))
    amounts = {r.label: r["count"] for r in marks.groupBy("label").count().collect()}
    chosen = [marks.filter(F.col("label") == k).orderBy("place", "doc_id").limit(sample) for k in (0, 1)]
    chosen = staged(chosen[0].unionByName(chosen[1]).withColumnRenamed("doc_id", "id"), "labels")
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("text", "label", "place")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [indicators(t) for t in batch.column(0).to_pylist()]
        columns = [pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64())]
        return pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), *columns], ["label", "place", "own", "n"])

    rows = staged(map_batches(met, run, "label int, place bigint, own binary, n bigint"), "indicators")
    sizes = np.array([(r.place, r.n) for r in rows.select("place", "n").orderBy("place", "n").limit(2 * sample).collect()], np.int64).reshape(-1, 2)
    fits = sizes[np.cumsum(sizes[:, 1]) <= most, 0]
    got = rows.filter(F.col("place") <= int(fits.max())).orderBy("place", "label", "own").limit(2 * sample).collect() if len(fits) else []
    sets = [np.frombuffer(r.own, np.int32) for r in got]
    # Equal texts are on the same side.
    apart = np.array([int(_mixed(np.append(s, len(s)).astype(np.uint64)).sum() % np.uint64(APART)) == 0 for s in sets], bool)
    share = amounts.get(1, 0) / max(1, sum(amounts.values()))
    return train(sets, np.array([r.label for r in got], np.int64), apart, share)


_models: dict = {}


def scored(docs: DataFrame, model) -> DataFrame:
    """doc_id, score and predicted (1 from GOOD on) of every row; null texts are empty ones; other columns are ignored."""
    held, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if key not in _models:
            _models.clear()
            _models[key] = held.value
        scores = np.array([score(t.as_py(), _models[key]) for t in batch.column(1)])
        columns = [pa.array(scores, pa.float64()), pa.array((scores >= GOOD).astype(np.int32))]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "score", "predicted"])

    rows = docs.select("doc_id", "text")
    return map_batches(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def op12_quality(spark, directory):
    docs = table(spark, directory, "documents")
    found = scored(docs, fit(docs, table(spark, directory, "labels")))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")
