"""Exact top-k inner products by pivot-table elimination.

The inner product is turned into a distance by the norms: ``2 q.x = |q|^2 + |x|^2 - d(q, x)^2``.
A table of every vector's distances to the same few dozen pivots bounds d from below. One pivot
gives the triangle inequality; all together say where a vector lies in the space that the pivots
span and how far it is from it, and no lower bound that these distances allow is larger than the
distance of two such places with their remainders turned alike. As a score that is the inner
product of the places plus the product of the remainders' lengths. In each block of candidates
every query walks its candidates by falling upper bound and stops as soon as no bound can reach
its k-th score so far; a block returns k rows per query, and those are merged.

Queries meet candidates block by block: query groups are sent to every candidate block. That is
the asked search (a stated query set against all rows), not a join of all pairs; what leaves a
block is k rows per query, never pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from diagarc.llm.common import staged, table

EXACT = 1 << 52


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id and scale * component as doubles; null vectors, or with null or non-finite components, go."""
    x = F.col(embedding)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vectors.filter(x.isNotNull()).filter(finite).select(
        F.col(vec_id).alias("vec_id"), F.transform(x, lambda c: c.cast("double") * scale).alias("v"))


def _matrix(column: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Whole numbers, held in doubles; shorter vectors end in zeros."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), max(width, sizes.max(initial=0))))
    out[np.arange(out.shape[1])[None] < sizes[:, None]] = np.floor(lists.flatten().to_numpy(zero_copy_only=False))
    return out


def _wide(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


def _scores(q, x, exact):
    if exact:  # below 2^52 in magnitude, where doubles hold every integer
        return (x @ q).astype(np.int64)
    own = [int(c) for c in q]
    return np.array([max(-(2**63), min(2**63 - 1, sum(a * int(c) for a, c in zip(own, row)))) for row in x], dtype=np.int64)


def _places(d2: np.ndarray, own2: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From squared distances to the pivots: places in the pivots' span, and at least the lengths of what is outside it."""
    p2 = (pivots * pivots).sum(1)
    spread, axes = np.linalg.eigh(pivots @ pivots.T)
    kept = spread > 1e-8 * spread.max(initial=0)  # a direction left out counts to the remainder
    places = (own2[:, None] + p2[None] - d2) / 2 @ (axes[:, kept] / np.sqrt(spread[kept]))
    room = 1e-10 * (own2 + p2.max(initial=0))  # what rounding may have taken from the remainder
    return places, np.sqrt(np.maximum(0, own2 - (places * places).sum(1)) + room)


def _best_of_block(queries: pa.Table, cands: pa.Table, pivots: np.ndarray, k: int, step: int) -> pa.Table:
    qs, xs = _matrix(queries["v"]), _matrix(cands["v"])
    width = max(pivots.shape[1], qs.shape[1], xs.shape[1])
    qs, xs, pv = _wide(qs, width), _wide(xs, width), _wide(pivots, width)
    with np.errstate(over="ignore", invalid="ignore"):
        exact = np.abs(qs).max(initial=0) * np.abs(xs).max(initial=0) * max(1, width) < EXACT
        pv = pv[(pv * pv).sum(1) < 1e100]  # beyond that the span can't be computed in doubles
        q2, x2, p2 = (qs * qs).sum(1), (xs * xs).sum(1), (pv * pv).sum(1)
        dq, dx = q2[:, None] + p2[None] - 2 * qs @ pv.T, x2[:, None] + p2[None] - 2 * xs @ pv.T
        (cq, rq), (cx, rx) = _places(dq, q2, pv), _places(dx, x2, pv)
        q1, x1, p1 = np.sqrt(q2), np.sqrt(x2), np.sqrt(p2.max(initial=0))
    named = ~np.asarray(cands["vec_id"].is_null())
    ids = np.asarray(cands["vec_id"].fill_null(2**63 - 1))
    out = []
    for n, query in enumerate(queries["query_id"].to_pylist()):
        with np.errstate(over="ignore", invalid="ignore"):
            bound = cx @ cq[n] + rx * rq[n] + 1e-9 * (q1[n] + p1) * (x1 + p1) + 1
        bound[np.isnan(bound)] = np.inf  # too large for doubles: nothing is excluded
        bound[(ids == query) & named] = -np.inf
        first = np.argpartition(-bound, step)[:step] if len(bound) > step else np.arange(len(bound))
        own = first[bound[first] > -np.inf]
        score = _scores(qs[n], xs[own], exact)
        seen = len(own)
        best = np.lexsort((ids[own], ~named[own], ~score))[:k]  # ~: the least bigint has no negative
        own, score = own[best], score[best]
        # Only candidates whose bound reaches the k-th score are left; they are taken by falling bound.
        rest = np.setdiff1d(np.flatnonzero(bound >= (score[-1] if len(score) == k else -np.inf)), first)
        rest = rest[bound[rest] > -np.inf]
        rest = rest[np.argsort(-bound[rest], kind="stable")]
        at, size = 0, 4 * step
        while at < len(rest) and (len(score) < k or bound[rest[at]] >= score[-1]):
            part = rest[at : at + size]
            own, score = np.append(own, part), np.append(score, _scores(qs[n], xs[part], exact))
            best = np.lexsort((ids[own], ~named[own], ~score))[:k]
            own, score = own[best], score[best]
            at, size, seen = at + size, 2 * size, seen + len(part)
        # The block's number of evaluated candidates stands at its first row.
        out.append((np.full(len(own), query), score, ids[own], ~named[own], np.where(np.arange(len(own)) == 0, seen, 0)))
    query, score, vec, unnamed, seen = (np.concatenate(c) for c in zip(*out))
    return pa.table({"query_id": pa.array(query, pa.int64()), "score": pa.array(score, pa.int64()),
                     "vec_id": pa.array(vec, pa.int64(), mask=unnamed), "seen": pa.array(seen, pa.int64())})


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, n_pivots: int = 48, block_rows: int = 8192,
          query_rows: int = 2048, step: int = 64, counts: bool = False) -> DataFrame:
    """The k best candidates of every query: query_id, rank, vec_id, score.

    Queries are the distinct ids divisible by ``every`` (of repeated ids the smallest vector
    counts); candidates are all rows with another id, repeated rows included. Ties go to the
    smaller id, null ids last. Shorter vectors count as followed by zeros. A score outside bigint is
    held at its end. Empty input: no rows. With ``counts`` also evaluated, the number of candidates
    whose score the query computed.
    """
    spark = vectors.sparkSession
    rows = staged(quantised(vectors), "vectors")
    n = rows.count()
    queries = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks, groups = max(1, -(-n // block_rows)), max(1, -(-n // every // query_rows))
    # A stated number of pivots: the vectors with the smallest hashes.
    chosen = rows.select("v").orderBy(F.xxhash64("v")).limit(n_pivots).collect()
    pivots = _matrix(pa.chunked_array([pa.array([r.v for r in chosen], pa.list_(pa.float64()))]))

    # By place in the staged files: copies of a vector, and whole repeated rows, are dealt evenly.
    cands = rows.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).cast("int"))
    queries = queries.withColumn("group", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
    left = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    # Not by the candidates' column name: Catalyst would drop a column that both sides share when a reader drops any.
    left = left.select("group", "block", F.col("vec_id").alias("query_id"), "v")
    right = cands.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).select("group", "block", "vec_id", "v")

    def search(q: pa.Table, c: pa.Table) -> pa.Table:
        if q.num_rows and c.num_rows:
            return _best_of_block(q, c, pivots, k, step)
        return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "score", "vec_id", "seen")})

    best = left.groupBy("group", "block").cogroup(right.groupBy("group", "block")).applyInArrow(search, "query_id bigint, score bigint, vec_id bigint, seen bigint")
    ranked = best.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))))
    ranked = ranked.withColumn("evaluated", F.sum("seen").over(W.partitionBy("query_id"))) if counts else ranked
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", *["evaluated"] * counts)


SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda c: floor(256 * c::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from scored qualify rank <= 5"""


def op7_pivot_top_k(spark, directory):
    return top_k(table(spark, directory, "embeddings"))
