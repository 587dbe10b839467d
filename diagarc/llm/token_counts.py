"""Token counts under a unigram vocabulary, without producing the tokens.

An Aho-Corasick automaton lists the vocabulary matches that end at each character, longest first.
A forward pass keeps for every position the best score and the number of pieces on that path.
Ties keep the match that starts earliest, as the tokenizer's own search does: it walks starts in
order and replaces a path only by a strictly better one. A character without a match costs the
smallest score less 10 and counts its UTF-8 bytes (byte fallback).

No piece goes on over a word mark after other characters, so the best path of a text is the best
paths of its marked words one after the other, and each distinct word is searched once per worker.
"""

from __future__ import annotations

import re
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diagarc.llm.common import map_batches, table

MARK = "▁"
UNKNOWN_PENALTY = 10.0
_CACHE_WORDS = 400_000


def vocabulary(model: str | None = None) -> list[tuple[str, float]]:
    """Ordinary pieces and scores of a SentencePiece file; control, unknown and byte pieces are left out."""
    import public_tokenizers
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=model or public_tokenizers.path("piece_bpe_32k.model"))
    special = lambda i: pieces.IsControl(i) or pieces.IsUnknown(i) or pieces.IsByte(i) or pieces.IsUnused(i)
    return [(pieces.IdToPiece(i), pieces.GetScore(i)) for i in range(pieces.GetPieceSize()) if not special(i)]


class Counter(dict):
    """Counts pieces of marked text; as a dict, of single words."""

    def __init__(self, pieces: list[tuple[str, float]], lowest: float | None = None):
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min([s for _, s in pieces] + ([lowest] if lowest is not None else [])) - UNKNOWN_PENALTY
        self.whole = any(re.search(f"[^{MARK}]{MARK}", p) for p, _ in pieces)
        self.unit = re.compile(r"(?s).+" if self.whole else f"{MARK}*[^{MARK}]+|{MARK}+")

    def word(self, word: str) -> tuple[int, int, float]:
        """(pieces, of them bytes, score) of the best path."""
        n = len(word)
        score, count, fallback = [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        matches = self.automaton.iter(word)
        end, match = next(matches, (n, None))
        for i in range(n):
            best, pieces, odd, single = None, 0, 0, False
            while end == i:
                length, own = match
                at = i + 1 - length
                single = single or length == 1
                total = own + score[at]
                if best is None or total > best:
                    best, pieces, odd = total, count[at] + 1, fallback[at]
                end, match = next(matches, (n, None))
            if not single:
                total = self.unknown + score[i]
                if best is None or total > best:
                    size = len(word[i].encode())
                    best, pieces, odd = total, count[i] + size, fallback[i] + size
            score[i + 1], count[i + 1], fallback[i + 1] = best, pieces, odd
        return count[n], fallback[n], score[n]

    def __missing__(self, word: str) -> int:
        """Of a word after one mark: pieces, and bytes above the 32nd bit."""
        pieces, odd, _ = self.word(MARK + word)
        got = pieces + (odd << 32)
        if len(word) <= 60:
            if len(self) >= _CACHE_WORDS:
                self.clear()
            self[word] = got
        return got

    def text(self, text: str) -> tuple[int, int]:
        """(pieces, of them bytes); a mark is put before the text and in place of every space."""
        if not text:
            return 0, 0
        words = text.replace(" ", MARK).split(MARK)
        if self.whole or "" in words:  # runs of marks may be pieces
            got = [self.word(u)[:2] for u in self.unit.findall(MARK + MARK.join(words))]
            return sum(g[0] for g in got), sum(g[1] for g in got)
        got = sum([self[w] for w in words])
        return got & 0xFFFFFFFF, got >> 32


_counters: dict[str, Counter] = {}


def counter(key: str, pieces) -> Counter:
    if key not in _counters:
        _counters[key] = Counter(pieces)
    return _counters[key]


def token_counts(docs: DataFrame, model: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_byte_tokens of every row; null and empty texts have 0 tokens.

    Repeated rows and null ids stay rows of their own; other columns are ignored.
    """
    pieces = docs.sparkSession.sparkContext.broadcast(vocabulary(model))
    key = blake2b(repr(pieces.value).encode("utf-8", "surrogatepass")).hexdigest()

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = counter(key, pieces.value)
        got = [own.text(t.as_py() or "") for t in batch.column(1)]
        counts = [pa.array([g[i] for g in got], pa.int64()) for i in range(2)]
        return pa.RecordBatch.from_arrays([batch.column(0), *counts], ["doc_id", "n_tokens", "n_byte_tokens"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, count, f"doc_id {kind}, n_tokens bigint, n_byte_tokens bigint")


def op10_token_counts(spark, directory):
    return token_counts(table(spark, directory, "documents"))
