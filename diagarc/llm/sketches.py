"""Document fingerprints: threshold-scaled sketches of character shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range; a text of few different
shingles keeps them all, and says so. Sizes follow the text, at one fraction the same shingle is
kept everywhere or nowhere, and the sketch of two texts together comes from theirs: containment
between a paragraph and a book can be read off directly. Two sketches are compared at the lower of
their fractions; where a short text is too few hashes for that and the long text is at hand, as in
the query, that one's hashes are made anew at the short one's fraction.

The query compares each document with the next one by id. Ids are cut into ranges by quantiles,
texts are moved once by range, the first document of each range is also sent to the range before,
and each task walks its ranges in order, holding two documents at a time.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diagarc.llm.common import map_batches, table

SHINGLE = 12
FRACTION = 1 / 32
#: A text of so many different shingles at most keeps them all.
FEW = 256
_R = np.uint64(0x9E3779B97F4A7C15)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """r^i and r^-i modulo 2^64 for i below n."""
    if len(_powers[0]) < n:
        size, inverse = 1 << n.bit_length(), pow(int(_R), -1, 1 << 64)
        for k, base in enumerate((int(_R), inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def window_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of every run of ``width`` codes."""
    up, down = powers(len(codes))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(codes.astype(np.uint64) + np.uint64(1)) * up)])
    return _mixed((sums[width:] - sums[:-width]) * down[: len(codes) - width + 1])


class Sketch(NamedTuple):
    """Sorted distinct shingle hashes: all of them, or those below the fraction."""

    hashes: np.ndarray
    whole: bool


def shingles(text: str, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle; empty: none."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return np.unique(window_hashes(codes, min(width, len(codes)))) if len(codes) else np.zeros(0, np.uint64)


def _below(hashes: np.ndarray, fraction: float) -> np.ndarray:
    return hashes[: np.searchsorted(hashes, np.uint64(int(fraction * 2**64)))]


def sketch(text: str, width: int = SHINGLE, fraction: float = FRACTION, few: int = FEW) -> Sketch:
    own = shingles(text, width)
    return Sketch(own, True) if len(own) <= few else Sketch(_below(own, fraction), False)


def merged(a: Sketch, b: Sketch, fraction: float = FRACTION, few: int = FEW) -> Sketch:
    """The sketch of all shingles of both, as if they had been one text."""
    both = np.union1d(a.hashes, b.hashes)
    if a.whole and b.whole and len(both) <= few:
        return Sketch(both, True)
    return Sketch(_below(both, fraction), False)


def _share(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def containment(a: Sketch, b: Sketch, fraction: float = FRACTION) -> float | None:
    """Share of the smaller sketch that is in the other, at the fraction of both.

    Two empty texts are alike, an empty and another are not. None where one text keeps all
    its hashes, the other does not, and none of the former's are below the fraction: then the sketches cannot tell.
    """
    if a.whole == b.whole:
        return _share(a.hashes, b.hashes)
    short, long = (a, b) if a.whole else (b, a)
    if not len(short.hashes):
        return 0.0
    own = _below(short.hashes, fraction)
    return _share(own, long.hashes) if len(own) else None


def likeness(text: str, a: Sketch, other: str, b: Sketch, width: int = SHINGLE) -> float:
    """Containment where both texts are at hand: at fraction 1 if either keeps all its hashes."""
    if a.whole == b.whole:
        return _share(a.hashes, b.hashes)
    return _share(a.hashes if a.whole else shingles(text, width), b.hashes if b.whole else shingles(other, width))


def digest(hashes: np.ndarray) -> str:
    """Fixed-width hexadecimal of each hash's upper 48 bits, in order."""
    return (hashes >> np.uint64(16)).astype(">u8").view("u1").reshape(-1, 8)[:, 2:].tobytes().hex()


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE, fraction: float = FRACTION) -> DataFrame:
    """doc_id, n_chars, hashes (bigint array), whole (all hashes are kept) of every row; null text counts as empty. No shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        own = [sketch(t, width, fraction) for t in texts]
        columns = [pa.array(map(len, texts), pa.int64()), pa.array([k.hashes.view(np.int64) for k in own], pa.list_(pa.int64())), pa.array([k.whole for k in own], pa.bool_())]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_chars", "hashes", "whole"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_batches(docs.select(doc_id, text), run, f"doc_id {kind}, n_chars bigint, hashes array<bigint>, whole boolean")


def with_next(docs: DataFrame) -> DataFrame:
    """Texts ordered for a walk: (bucket, extra, doc_id, text), sorted within tasks.

    Each bucket is a range of ids; the row that follows its last one comes once more at its end,
    marked ``extra``. After the last document comes the first. Null ids come first; rows with
    the same id follow a hash of their text.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(-(2**63))).alias("key"))
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("key", [i / n for i in range(1, n)])).first()[0] if n > 1 else []
    cuts = sorted(set(cuts or []))

    def bucket(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(cuts, dtype=np.int64), key.to_numpy(), side="right").astype(np.int32))

    in_bucket = F.pandas_udf(bucket, "int")
    heads = {r.bucket: r.head for r in rows.groupBy(in_bucket("key").alias("bucket")).agg(F.min("key").alias("head")).collect()}
    order = sorted(heads)
    before = {heads[b]: order[i - 1] for i, b in enumerate(order)}  # one id per range

    def targets(key: pd.Series) -> pd.Series:
        return pd.Series([[bisect_right(cuts, k), before.get(k, -1)] for k in key])

    places = F.posexplode(F.pandas_udf(targets, "array<int>")("key")).alias("extra", "bucket")
    dealt = rows.select("*", places).filter("bucket >= 0").repartition("bucket")
    return dealt.withColumn("_tie", F.xxhash64("text")).sortWithinPartitions("bucket", "extra", "key", "_tie").select("bucket", "extra", "doc_id", "text")


OUT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_and_next(docs: DataFrame, width: int = SHINGLE, fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike it is to that and to the next document.

    The edited text ends in the beginning of the next document instead of its own second half.
    One row per input row; null text is empty, and a document alone is its own next.
    """
    names = [c.split()[0] for c in OUT.split(", ")]

    def walk(batches):
        last, out = None, []  # last: bucket, id, text, sketch

        def pair(text, own):
            n = len(last[2])
            edited = last[2][: n - n // 2] + text[: n // 2]
            changed = sketch(edited, width, fraction)
            out.append((last[1], n, hashlib.sha256(edited.encode()).hexdigest(), digest(last[3].hashes), digest(changed.hashes),
                        likeness(last[2], last[3], edited, changed, width), likeness(last[2], last[3], text, own, width)))

        def flush():
            rows = [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2))]
            out.clear()
            return pa.RecordBatch.from_arrays(rows, names)

        for batch in batches:
            for bucket, extra, doc_id, text in zip(*[batch.column(i) for i in range(4)]):
                bucket, extra, text = bucket.as_py(), extra.as_py(), text.as_py()
                if extra and (last is None or last[0] != bucket):
                    continue  # a further row with the next id
                own = sketch(text, width, fraction)
                if last is not None and last[0] == bucket:
                    pair(text, own)
                last = None if extra else (bucket, doc_id.as_py(), text, own)
                if len(out) >= 500:
                    yield flush()
        if out:
            yield flush()

    return with_next(docs).mapInArrow(walk, OUT)


def op5_fingerprints(spark, directory):
    return edited_and_next(table(spark, directory, "documents"))
