"""Packing documents into sequences by best fit over a histogram of lengths.

Documents are tokenised and closed with an end id; longer ones are cut into full pieces, the
first of which may be shorter. Only the histogram of piece lengths (at most ``capacity`` rows)
reaches the driver. Best fit runs over counts: sequences with the same free space are one group,
so a step places all pieces of a length into a group at once. The plan is a short list of rank
ranges per length; each piece takes its place by joining its rank within its length with it.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diagarc.llm.common import buckets_of, kept, map_batches, running_before, staged, table

CAPACITY = 1024
END_ID = 2
#: A cut before a white-space run never changes the tokens: no token spans it, and the run stays whole.
_UNIT = re.compile(r"\s*\S+|\s+")
#: White space to Python but not to the tokenizer's pattern.
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")
_CACHE_UNITS, _CACHE_CHARS = 400_000, 60


def _byte_characters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder(dict):
    """Ids of a text as little-endian 32-bit bytes; as a dict, those of words with a space before them.

    A word that is empty or ends in white space has None: a cut before the next space could
    split a run of white space, so such texts are cut by pattern.

    Ids are those of the ``tokenizers`` file. When its merges are numbered in order, units are
    merged by rank with ``tiktoken``, which gives the same ids; otherwise by ``tokenizers``.
    Texts with special tokens or odd separators go to ``tokenizers`` whole.
    """

    def __init__(self, description: str, pattern: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(description)
        spec = json.loads(description)
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.odd = (*_SEPARATORS, *self.special)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in merges]
        byte = _byte_characters()
        self.unit_ids = lambda text: self.whole.encode(text, add_special_tokens=False).ids
        if spec.get("normalizer") is None and all(vocab.get(j) == 256 + i for i, j in enumerate(joined)):
            import tiktoken

            ranks = {bytes(byte[c] for c in word): i for word, i in vocab.items() if word not in self.special}
            self.unit_ids = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def unit(self, text: str) -> bytes:
        return np.array(self.unit_ids(text), dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes | None:
        ids = None if not word or word[-1].isspace() else self.unit(" " + word)
        if len(word) <= _CACHE_CHARS:
            if len(self) >= _CACHE_UNITS:
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.odd):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        first, *words = text.split(" ")
        if first and not first[-1].isspace():
            found = [self[w] for w in words]
            if None not in found:
                return self.unit(first) + b"".join(found)
        return b"".join([self.unit(u) for u in _UNIT.findall(text)])


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the pieces of every row; a null or empty text is its end id alone."""
    import public_tokenizers

    with open(tokenizer or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        text = f.read()
    description, key = docs.sparkSession.sparkContext.broadcast(text), f"encoder {hashlib.sha256(text.encode()).hexdigest()}"
    pattern, end = public_tokenizers.PATTERN, np.array([end_id], dtype="<u4").tobytes()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = kept(key, lambda: Encoder(description.value, pattern))
        row, piece, start, length, crc = [], [], [], [], []
        for i, text in enumerate(batch.column(1)):
            ids = own.encode(text.as_py() or "") + end
            n = len(ids) // 4
            at, stop, k = 0, n % capacity or min(n, capacity), 0
            while at < n:
                row.append(i), piece.append(k), start.append(at), length.append(stop - at)
                crc.append(zlib.crc32(ids[4 * at : 4 * stop]))
                at, stop, k = stop, stop + capacity, k + 1
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
             pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint", keep=key)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """Best fit over counts, longest first.

    For each length: ranges (first rank, end rank, first sequence, pieces per sequence, offset). Sequences
    that have the same space left after the same steps are consecutive numbers and move as one.
    """
    free: list[tuple[int, int, int]] = []  # (space, first sequence, sequences), sorted
    out, sequences = {}, 0
    for length in sorted(counts, reverse=True):
        rank, left, ranges = 0, counts[length], []
        while left:
            at = bisect_left(free, (length, -1, -1))
            if at < len(free):
                space, first, n = free.pop(at)
            else:
                space, first = capacity, sequences
                n = -(-left // (capacity // length))
                sequences += n
            each = space // length
            full = min(n, left // each)
            if full:
                ranges.append((rank, rank + full * each, first, each, capacity - space))
                if space > each * length:
                    insort(free, (space - each * length, first, full))
                rank, left, first, n = rank + full * each, left - full * each, first + full, n - full
            if n and left and left < each:
                ranges.append((rank, rank + left, first, left, capacity - space))
                if space > left * length:
                    insort(free, (space - left * length, first, 1))
                rank, left, first, n = rank + left, 0, first + 1, n - 1
            if n:
                insort(free, (space, first, n))
        out[length] = ranges
    return out


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Rows are documents, repeated rows and null ids included; a null or empty text still takes one
    token. Other columns are ignored. Empty input: no rows.
    """
    spark = docs.sparkSession
    rows = staged(pieces(docs, tokenizer, capacity, end_id), "pieces")
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # at most ``capacity`` rows
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets_of(sum(counts.values())))))
    rows = rows.withColumn("_one", F.lit(1).cast("bigint"))
    ranked = running_before(rows, ["length"], "_part", ["doc_id", "piece", "ids_crc32"], "_one", "_rank")
    names = ("first", "end", "sequence", "each", "at")
    ranges = [{"length": length, "_ranges": [dict(zip(names, r)) for r in rs]} for length, rs in plan(counts, capacity).items()]
    kind = pa.schema([("length", pa.int64()), ("_ranges", pa.list_(pa.struct([(n, pa.int64()) for n in names])))])
    placed = ranked.join(spark.createDataFrame(pa.Table.from_pylist(ranges, kind)), "length")
    own = F.filter("_ranges", lambda r: (F.col("_rank") >= r["first"]) & (F.col("_rank") < r["end"]))[0]
    placed = placed.withColumn("_own", own).withColumn("_nth", F.col("_rank") - F.col("_own.first"))
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("_own.sequence") + F.floor(F.col("_nth") / F.col("_own.each"))).alias("sequence_id"),
        (F.col("_own.at") + F.col("_nth") % F.col("_own.each") * F.col("length")).alias("offset"))


def op6_pack_best_fit(spark, directory):
    return pack(table(spark, directory, "documents"))
