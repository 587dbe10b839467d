"""Language identification by a linear-chain conditional random field over words.

Features of a word are its character n-grams with word ends marked (those that touch an end are
its affixes) and the word itself (the lexicon), hashed into one weight table. Transition weights
are learned with them from code-switched sequences, made by joining short runs of words of
training documents. Forward-backward gives each word's posterior over languages; a document's
prediction is the language with the largest mean posterior, which is also its score.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from diagarc.llm.common import map_batches, slices, table

BITS = 18
GRAMS = (2, 3, 4)
#: The bound of the training sample: documents, and words of each (a run at a hashed place).
SAMPLE_DOCS, SAMPLE_WORDS = 3000, 60
_CACHE_WORDS, _WORDS_AT_ONCE, _CHARS_AT_ONCE = 300_000, 8192, 1 << 20
_START, _END = 0x110000, 0x110001


def normal(token: str) -> str:
    """The letters of a token, in lower case."""
    low = token.lower()
    return low if low.isalpha() else "".join(c for c in low if c.isalpha())


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Weight table rows of all features of all words, and where each word's begin."""
    sizes = np.array([len(w) for w in words], dtype=np.int64) + 2
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    codes = np.empty(int(sizes.sum()), np.uint64)
    inner = np.ones(len(codes), bool)
    inner[begins] = inner[begins + sizes - 1] = False
    codes[inner] = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    codes[begins], codes[begins + sizes - 1] = _START, _END
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(codes)) - begins[word]
    rows, owners = [], []
    h = codes.copy()
    for n in range(2, max(GRAMS) + 1):
        h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :]
        if n in GRAMS:
            whole = place[: len(h)] + n <= sizes[word[: len(h)]]
            g = (h[whole] + np.uint64(n)) * np.uint64(0xBF58476D1CE4E5B9)
            rows.append((g ^ (g >> np.uint64(29))) >> np.uint64(64 - BITS))
            owners.append(word[: len(h)][whole])
    own = np.array([zlib.crc32(w.encode()) for w in words], dtype=np.uint64) * np.uint64(0x94D049BB133111EB)
    rows.append(own >> np.uint64(64 - BITS))
    owners.append(np.arange(len(words)))
    rows, owners = np.concatenate(rows).astype(np.int64), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return rows[order], np.searchsorted(owners[order], np.arange(len(words)))


def emissions(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Scores (word, language) of words that have at least one letter."""
    if not words:
        return np.zeros((0, weights.shape[1]), np.float32)
    rows, begins = features(words)
    return np.add.reduceat(weights[rows], begins, axis=0)


def posteriors(scores: np.ndarray, begins: np.ndarray, sizes: np.ndarray, transitions: np.ndarray, sums: bool = True):
    """Forward-backward over many sequences at once, laid end to end in ``scores``.

    Returns each sequence's summed posteriors; or, without ``sums``, those of every word and the
    expected transitions. Sequences advance together, longest first.
    """
    order = np.argsort(-sizes, kind="stable")
    begins, sizes = begins[order], sizes[order]
    k = scores.shape[1]
    psi = np.exp(scores - scores.max(1, keepdims=True))
    step = np.exp(transitions - transitions.max())
    active = np.searchsorted(-sizes, -np.arange(1, sizes.max(initial=0) + 1), side="right")
    alpha = np.empty_like(psi)
    for t, n in enumerate(active):
        at = begins[:n] + t
        own = psi[at] if t == 0 else (alpha[at - 1] @ step) * psi[at]
        own /= own.sum(1, keepdims=True)
        alpha[at] = own
    total = np.zeros((len(sizes), k))
    words, pairs = (None, None) if sums else (np.empty_like(psi), np.zeros((k, k)))
    beta = np.ones((len(sizes), k), psi.dtype)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = begins[:n] + t
        post = alpha[at] * beta[:n]
        post /= post.sum(1, keepdims=True)
        total[:n] += post
        if not sums:
            words[at] = post
        ahead = psi[at] * beta[:n]
        if t and not sums:
            both = alpha[at - 1][:, :, None] * step[None] * ahead[:, None, :]
            pairs += (both / both.sum((1, 2), keepdims=True)).sum(0)
        back = ahead @ step.T
        beta[:n] = back / back.sum(1, keepdims=True)
    if not sums:
        return words, pairs
    out = np.empty_like(total)
    out[order] = total
    return out


def train(samples: list[tuple[str, list[str]]], epochs: int = 5, length: int = 64, batch: int = 32, rate: float = 0.3, seed: int = 7):
    """(languages, weights, transitions) fitted to (language, words) samples by AdaGrad on the likelihood."""
    languages = sorted({lang for lang, words in samples if words})
    rng = np.random.default_rng(seed)
    code = {lang: i for i, lang in enumerate(languages)}
    weights = np.zeros((1 << BITS, len(languages)), np.float32)
    transitions = np.zeros((len(languages), len(languages)))
    if len(languages) < 2:
        return languages, weights, transitions
    seen_w, seen_t = np.full_like(weights, 1e-4), np.full_like(transitions, 1e-4)
    vocab: dict[str, int] = {}
    runs = []
    for lang, words in samples:
        at = 0
        while at < len(words):
            size = int(rng.integers(4, 24))
            part = words[at : at + size]
            runs.append((code[lang], [vocab.setdefault(w, len(vocab)) for w in part]))
            at += size
    names = list(vocab)
    rows, starts = features(names)
    ends = np.append(starts[1:], len(rows))
    for _ in range(epochs):
        order = rng.permutation(len(runs))
        ids = np.concatenate([runs[i][1] for i in order])
        gold = np.concatenate([np.full(len(runs[i][1]), runs[i][0]) for i in order])
        for at in range(0, len(ids), length * batch):
            own, truth = ids[at : at + length * batch], gold[at : at + length * batch]
            begins = np.arange(0, len(own), length)
            sizes = np.minimum(length, len(own) - begins)
            unique, inverse = np.unique(own, return_inverse=True)
            spans = np.concatenate([rows[starts[u] : ends[u]] for u in unique])
            counts = ends[unique] - starts[unique]
            offsets = np.concatenate([[0], np.cumsum(counts)[:-1]])
            scores = np.add.reduceat(weights[spans], offsets, axis=0)[inverse].astype(np.float64)
            post, pairs = posteriors(scores, begins, sizes, transitions, sums=False)
            post[np.arange(len(own)), truth] -= 1
            change = np.zeros((len(unique), len(languages)))
            np.add.at(change, inverse, post)
            cells, where = np.unique(spans, return_inverse=True)
            slope = np.zeros((len(cells), len(languages)))
            np.add.at(slope, where, np.repeat(change, counts, axis=0))
            slope = slope / len(begins) + 1e-4 * weights[cells]
            seen_w[cells] += slope**2
            weights[cells] -= rate * slope / np.sqrt(seen_w[cells]) * 0.2
            follow = np.ones(len(own), bool)
            follow[begins] = False
            np.add.at(pairs, (truth[:-1][follow[1:]], truth[1:][follow[1:]]), -1)
            slope = pairs / len(begins)
            seen_t += slope**2
            transitions -= rate * slope / np.sqrt(seen_t) * 0.2
    return languages, weights, transitions


class Labeller:
    """Predictions with a cache of token scores; one per worker."""

    def __init__(self, model):
        self.languages, self.weights, self.transitions = model
        self.rows: dict[str, int] = {}
        self.table = np.zeros((0, len(self.languages)), np.float32)

    def _learn(self, tokens: set[str]) -> None:
        fresh = [t for t in tokens if t not in self.rows]
        if len(self.rows) + len(fresh) > _CACHE_WORDS:
            self.rows, self.table, fresh = {}, self.table[:0], list(tokens)
        words = [normal(t) for t in fresh]
        lettered = [w for w in words if w]
        at = len(self.table)
        for token, word in zip(fresh, words):
            self.rows[token] = at if word else -1
            at += bool(word)
        # A few words at a time: the list of their features is a hundred times their size.
        fresh_rows = [emissions(lettered[i : i + _WORDS_AT_ONCE], self.weights) for i in range(0, len(lettered), _WORDS_AT_ONCE)]
        self.table = np.concatenate([self.table, *fresh_rows])

    def label(self, texts: list[str | None]) -> list[tuple[str, float]]:
        # Texts of like length advance together, so slices can be small without more steps.
        order = sorted(range(len(texts)), key=lambda i: len(texts[i] or ""))
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        for begin, end in slices([texts[i] or "" for i in order], _CHARS_AT_ONCE):
            tokens = [(texts[i] or "").split() for i in order[begin:end]]
            self._learn(set().union(*tokens))
            rows = self.rows
            sizes = np.array([len(t) for t in tokens], dtype=np.int64)
            ids = np.fromiter((rows[w] for t in tokens for w in t), np.int64, int(sizes.sum()))
            owner = np.repeat(np.arange(len(tokens)), sizes)[ids >= 0]
            ids = ids[ids >= 0]
            sizes = np.bincount(owner, minlength=len(tokens))
            filled = np.flatnonzero(sizes)
            result: list[tuple[str, float]] = [("und", 0.0)] * len(tokens)
            if len(filled) and self.languages:
                begins = np.concatenate([[0], np.cumsum(sizes[filled])[:-1]])
                sums = posteriors(self.table[ids], begins, sizes[filled], self.transitions.astype(np.float32))
                mean = sums / sizes[filled][:, None]
                for i, row in zip(filled, mean):
                    result[i] = (self.languages[int(row.argmax())], float(min(1.0, row.max())))
            for i, found in zip(order[begin:end], result):
                out[i] = found
        return out


def held_out(doc_id: str = "doc_id"):
    """Rows that no model may learn from; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS):
    """The model of the rows that may be learned from: a bounded sample, chosen by hash, of short runs of words."""
    rows = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    n = rows.select("doc_id").count()
    share = max(1, n // sample_docs)
    rows = rows.select("lang", "text", F.xxhash64("doc_id").alias("h")).filter(F.pmod(F.xxhash64(F.col("h")), F.lit(share)) == 0)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = []
        for text, h in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            own = text.split()
            at = h % max(1, len(own) - sample_words + 1)
            words.append(" ".join(w for w in map(normal, own[at : at + sample_words]) if w))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(words), batch.column(2)], ["lang", "words", "h"])

    found = map_batches(rows, run, "lang string, words string, h bigint").orderBy("h", "lang", "words").limit(2 * sample_docs).collect()
    return train([(r.lang, r.words.split()) for r in found])


_labellers: dict[str, Labeller] = {}


def label_documents(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and lang_pred, score of the column ``text``, or of a struct's field given as ``struct.field``.

    ``und`` and 0 for a null text, one without letters, and for all rows if nothing could be learned.
    """
    held, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    column, _, field = text.partition(".")
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]  # callers with such columns hand them over in a struct

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if key not in _labellers:
            _labellers.clear()
            _labellers[key] = Labeller(held.value)
        texts = batch.column(names.index(column))
        if field:
            texts = pc.struct_field(texts, field)
        got = _labellers[key].label(texts.to_pylist())
        columns = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
        return pa.RecordBatch.from_arrays([*batch.columns, *columns], [*names, "lang_pred", "score"])

    rows = docs.select(*[F.col(f"`{c}`") for c in names])
    return map_batches(rows, run, T.StructType([*rows.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def op4_language_id(spark, directory):
    docs = table(spark, directory, "documents")
    labelled = label_documents(docs.select("doc_id", "text"), fit(docs))
    return labelled.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
