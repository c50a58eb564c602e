"""Approximate nearest neighbours by a permutation index.

A vector is the order of its nearest pivots.  Each shard posts its vectors in
the inverted files of those pivots, ranks a query's postings by the footrule
distance of the orders, and reranks the best share by exact distance.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from driftwell.llm import vectors


class PermutationFiles:
    """Inverted files of the pivots: which vectors' orders hold one, and how near its beginning."""

    def __init__(self, order: np.ndarray, pivots: int):
        self.size, self.prefix = order.shape
        flat = order.ravel().astype(np.int64)
        by = np.argsort(flat, kind="stable")
        self.lists = np.searchsorted(flat[by], np.arange(pivots + 1))
        self.member = by // self.prefix
        self.left = self.prefix - by % self.prefix  # prefix length less the pivot's place

    def candidates(self, order: np.ndarray, share: float, least: int) -> np.ndarray:
        """The share of the vectors whose orders have the smallest footrule distances.

        With l places and pivots missing from an order at place l, the distance
        is a constant less twice the sum of min(l - a, l - b) over the pivots that
        both orders hold, so the query's own inverted files suffice.
        """
        n = self.lists[order + 1] - self.lists[order]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.lists[order], n)
        mine = np.repeat(self.prefix - np.arange(self.prefix), n)
        near = np.bincount(self.member[at], weights=np.minimum(mine, self.left[at]), minlength=self.size)
        take = min(self.size, max(least, int(np.ceil(share * self.size))))
        key = -near * self.size + np.arange(self.size)
        return np.argpartition(key, take - 1)[:take]


def nearest(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, k: int = 10, pivots: int = 2048, prefix: int = 128, share: float = 0.06, seed: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query by Euclidean distance.

    Queries are the rows whose id is divisible by ``every``; a row is no
    candidate of its own, but one that repeats it is.  The pivots are a seeded
    sample of ``pivots`` vectors (the only thing fitted, so a bounded one);
    every usable vector is indexed.  ``share`` is the share of a shard's
    distinct vectors that is reranked, 8 * ``k`` at least; copies of a vector
    count once there.  See ``vectors.usable`` for what takes no part.  Ties go
    to the smaller id; no usable vector gives no row, other columns are ignored.
    """
    rows = vectors.usable(df, id_col, vector_col, zero=False)
    centres = vectors.sample(rows, pivots, seed)
    if not len(centres):
        centres = np.zeros((1, 1))
    length = min(prefix, len(centres))

    def floor(asked: np.ndarray) -> np.ndarray:
        """A distance that ``k`` other rows of the sample are within, a little raised against rounding."""
        if len(centres) <= k:
            return np.full(len(asked), np.inf)
        far = (asked**2).sum(1)[:, None] - 2 * asked @ centres.T + (centres**2).sum(1)
        return np.sqrt(np.maximum(np.partition(far, k, axis=1)[:, k], 0) * (1 + 1e-6) + 1e-6 * (asked**2).sum(1))

    def each(shard: vectors.Shard, asked: vectors.Round) -> list[np.ndarray]:
        files = PermutationFiles(shard.order, len(centres))
        found = []
        for i, order in enumerate(vectors.nearest_of(asked.rows, centres, length)):
            some = files.candidates(order, share, 8 * k)
            far = np.sqrt(((shard.rows[some] - asked.rows[i]) ** 2).sum(1))
            last = np.partition(far, min(k, len(far) - 1))[min(k, len(far) - 1)]  # one more than k: its own row may be among them
            near = far <= min(last, asked.floor[i])
            found.append((np.full(near.sum(), i), some[near], far[near]))
        return vectors.expand(asked, shard, *(np.concatenate(c) for c in zip(*found)), k)

    return vectors.searched(rows, vectors.dealt(rows, k + 1, centres[: vectors.CENTRES], centres, length), every, k, floor, each, "double", lambda key: key)


def op5_permutation_index(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
