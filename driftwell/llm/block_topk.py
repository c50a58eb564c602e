"""Exact top-k inner products with block-at-a-time pruning.

A shard's similar vectors stand in blocks.  A block keeps each term's largest
and smallest weight; their products with a query's weights, summed, bound its
scores.  Blocks are scored through their forward index in order of that bound,
until it is below the query's kth score.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.llm import vectors

BLOCK = 64
#: Blocks of each query that are scored before its kth score is looked at again; four times as many each time.
FIRST = 4


def block_search(rows: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, row, score) of each query's ``k`` + 1 best rows and all that tie with the last, if they
    reach its ``floor``, and how many pairs of query and block were scored.

    ``rows`` are whole numbers, as doubles whose scores are exact, or as Python's.
    """
    starts = np.arange(0, len(rows), BLOCK)
    plain = rows.astype(np.float64)
    high, low = np.maximum.reduceat(plain, starts), np.minimum.reduceat(plain, starts)
    asked = queries.astype(np.float64)
    bounds = np.maximum(asked, 0) @ high.T + np.minimum(asked, 0) @ low.T
    if rows.dtype == object:  # rounding mustn't lower a bound
        bounds = bounds + np.abs(bounds) * 1e-9
    turn = np.argsort(-bounds, axis=1, kind="stable")
    bounds = np.take_along_axis(bounds, turn, axis=1)
    floor = floor.copy()
    query, row, score = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=rows.dtype)
    at, width, pairs = 0, FIRST, 0
    while at < len(starts):
        q, place = np.nonzero(bounds[:, at : at + width] >= floor[:, None])
        if not len(q):
            break
        pairs += len(q)
        block = turn[q, at + place]
        order = np.argsort(block, kind="stable")
        q, block = q[order], block[order]
        first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        found = [(query, row, score)]
        for a, b in zip(first, [*first[1:], len(q)]):
            begin = starts[block[a]]
            each = queries[q[a:b]] @ rows[begin : begin + BLOCK].T
            x, y = np.nonzero(each >= floor[q[a:b], None])
            found.append((q[a:b][x], begin + y, each[x, y]))
        query, row, score = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((-score, query)) if rows.dtype != object else np.array(sorted(range(len(score)), key=lambda i: (query[i], -score[i])), dtype=np.int64)
        query, row, score = query[order], row[order], score[order]
        first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, dtype=np.int64)
        last = first + k  # one more than k: the query's own row may be among them
        full = last < np.r_[first[1:], len(query)]
        floor[query[first[full]]] = np.maximum(floor[query[first[full]]], score[last[full]].astype(np.float64))
        keep = score >= floor[query]
        query, row, score = query[keep], row[keep], score[keep]
        at, width = at + width, 4 * width
    return query, row, score, pairs


def top_products(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20, scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each query.

    Components become floor(scale * x).  Queries are the rows whose id is
    divisible by ``every``; a row is no candidate of its own, but one that
    repeats it is.  Ties go to the smaller id.  See ``vectors.usable`` for what
    takes no part (zero vectors do); no usable vector gives no row, other
    columns are ignored.  Scores are exact; a component or a score beyond a
    long raises an error.
    """
    rows = vectors.usable(df, id_col, vector_col, zero=True)
    scaled = F.transform("v", lambda x: F.floor(x * scale).cast("double"))
    most, dim = rows.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x * scale)))), F.max(F.size("v"))).first()
    most, dim = (most or 0.0) + 1, dim or 1
    if most >= 2**62:
        raise OverflowError(f"components of up to {most:.3g} don't fit a long")
    exact = dim * most**2 < 2**53  # then sums of products are whole doubles
    rows = rows.withColumn("v", scaled)
    some = vectors.sample(rows, vectors.SAMPLE, 7)

    def floor(asked: np.ndarray) -> np.ndarray:
        """A score that ``k`` other rows of the sample have at least."""
        if not exact or len(some) <= k:
            return np.full(len(asked), -np.inf)
        return np.partition(asked @ some.T, len(some) - k - 1, axis=1)[:, len(some) - k - 1]

    def each(shard: vectors.Shard, asked: vectors.Round) -> list[np.ndarray]:
        own, theirs = shard.rows, asked.rows
        if not exact:
            own, theirs = (np.vectorize(int, otypes=[object])(x) for x in (own, theirs))
        query, row, score, _ = block_search(own, theirs, asked.floor, k)
        if not exact and len(score) and max(map(abs, score)) >= 2**63:
            raise OverflowError("a score doesn't fit a long")
        return vectors.expand(asked, shard, query, row, -score, k)

    centres = some[:: max(1, len(some) // vectors.CENTRES)][: vectors.CENTRES] if len(some) else np.zeros((1, dim))
    return vectors.searched(rows, vectors.dealt(rows, k + 1, centres), every, k, floor, each, "long", lambda key: (-key).astype(np.int64))


def op7_block_topk(spark, sf_dir: str) -> DataFrame:
    return top_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP7_SQL = """
WITH one AS (
  SELECT row_number() OVER () AS rid, vec_id, embedding AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
v AS (SELECT rid, vec_id, list_transform(e, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS w FROM one
      WHERE len(e) = (SELECT len(e) AS n FROM one GROUP BY n ORDER BY count(*) DESC, n DESC LIMIT 1)),
s AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.rid <> q.rid),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
