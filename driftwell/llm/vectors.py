"""Vector searches: distinct vectors dealt once into shards, and queries sent to them in rounds.

A shard is a range of similar vectors.  A round is a bounded number of queries,
broadcast with the score that each has at least; every shard answers it and
sends back only what can still be among the best.  Vectors are never repeated
for queries, nor queries for vectors.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwell.llm.store import discard, materialise, shared_dir, written

#: Vectors of a shard and queries of a round, at most about, and vectors that the driver samples.
SHARD_ROWS, ROUND_ROWS, SAMPLE = 16_384, 4_096, 4_096
CENTRES = 256


@dataclass
class Shard:
    """Distinct ``rows`` and the ascending ids of each: ``ids[starts[i]:starts[i + 1]]``."""

    rows: np.ndarray
    ids: np.ndarray
    starts: np.ndarray
    order: np.ndarray | None


@dataclass
class Round:
    """Queries: their number, id, how often the row is repeated, vector, and a floor of their kth best key."""

    number: np.ndarray
    ids: np.ndarray
    times: np.ndarray
    rows: np.ndarray
    floor: np.ndarray


def usable(df: DataFrame, id_col: str, vector_col: str, zero: bool) -> DataFrame:
    """(vec_id, v): every row but those left out, repeated ones too.

    Left out: null ids, null and empty vectors, vectors with a null or non-finite
    component, those whose length isn't the most common one (of two, the longer)
    and, unless ``zero``, zero vectors.
    """
    v = F.col("v")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size(v) > 0)
    if not zero:
        fine = fine & F.exists(v, lambda x: x != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull()).where(fine)
    rows = materialise(rows.select("vec_id", v.cast("array<double>").alias("v")), "vectors")
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (common["n"] if common else 0))


def sample(rows: DataFrame, n: int, seed: int) -> np.ndarray:
    """Distinct vectors among the ``n`` rows of the least hashes."""
    got = rows.orderBy(F.xxhash64("v", F.lit(seed)), "v", "vec_id").limit(n).select("v").collect()
    return np.unique(np.array([r["v"] for r in got], dtype=np.float64), axis=0) if got else np.zeros((0, 1))


def _matrix(column: pa.ListArray, kind: str = "f8") -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1), dtype=kind)


def nearest_of(rows: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The places of the ``n`` nearest centres of each row, the nearest first."""
    n, out = min(n, len(centres)), []
    for at in range(0, len(rows), 2_048):
        part = rows[at : at + 2_048]
        far = (centres**2).sum(1) - 2 * part @ centres.T
        some = np.argpartition(far, n - 1, axis=1)[:, :n]
        turn = np.argsort(np.take_along_axis(far, some, axis=1), axis=1, kind="stable")
        out.append(np.take_along_axis(some, turn, axis=1))
    return np.concatenate(out) if out else np.zeros((0, n), dtype=np.int64)


def dealt(rows: DataFrame, most: int, centres: np.ndarray, pivots: np.ndarray | None = None, prefix: int = 0) -> DataFrame:
    """Shards of distinct vectors (v, ids, shard, order), similar ones near each other.

    ``ids`` are a vector's ``most`` smallest ids; further ones can't be among as
    many best.  ``order`` is that of its ``prefix`` nearest pivots.  A vector
    that many rows share is cut to ``most`` of them before it is shuffled.
    """
    w = Window.partitionBy("v").orderBy("vec_id")
    one = rows.withColumn("n", F.row_number().over(w)).where(F.col("n") <= most).groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    with_order = pivots is not None

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _matrix(batch.column("v"))
            near = nearest_of(own, centres, 2) if len(own) else np.zeros((0, 2), dtype=np.int64)
            columns = [batch.column("v"), batch.column("ids"), pa.array(near[:, 0].astype(np.int32)), pa.array(near[:, -1].astype(np.int32))]
            if with_order:
                columns.append(pa.array(list(nearest_of(own, pivots, prefix).astype(np.int16)), pa.list_(pa.int16())))
            yield pa.RecordBatch.from_arrays(columns, names=["v", "ids", "cell", "next", *["order"] * with_order])

    placed = one.mapInArrow(place, "v array<double>, ids array<long>, cell int, next int" + ", order array<short>" * with_order)
    keys = ["cell", "next", F.xxhash64("v")]
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    ranged = placed.repartitionByRange(shards, *keys).sortWithinPartitions(*keys)
    return materialise(ranged.withColumn("shard", F.spark_partition_id()).drop("cell", "next"), "shards")


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    held: list[pa.RecordBatch] = []

    def whole() -> Shard:
        t = pa.Table.from_batches(held).combine_chunks()
        ids = t.column("ids").chunk(0)
        order = _matrix(t.column("order").chunk(0), "i2") if "order" in t.column_names else None
        return Shard(_matrix(t.column("v").chunk(0)), ids.flatten().to_numpy(), np.r_[0, np.cumsum(ids.value_lengths().to_numpy())], order)

    for batch in batches:
        shard = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1), len(shard)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and (held[-1].column("shard")[0].as_py() != shard[a] or sum(map(len, held)) > 2 * SHARD_ROWS):
                yield whole()
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield whole()


def _rounds(asked: DataFrame, floor: Callable[[np.ndarray], np.ndarray]) -> Iterator[Round]:
    held, n = [], 0

    def whole() -> Round:
        rows = np.array([r["v"] for r in held], dtype=np.float64)
        return Round(np.arange(n, n + len(held)), np.array([r["vec_id"] for r in held]), np.array([r["times"] for r in held]), rows, floor(rows))

    for r in asked.toLocalIterator():
        held.append(r)
        if len(held) == ROUND_ROWS:
            yield whole()
            n, held = n + len(held), []
    if held:
        yield whole()


def expand(asked: Round, shard: Shard, query: np.ndarray, vector: np.ndarray, key: np.ndarray, k: int) -> list[np.ndarray]:
    """Of candidates (query, vector, key), the ``k`` rows of the least keys of each query, ties to the smaller id, without its own row."""
    n = np.diff(shard.starts)[vector]
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(shard.starts[vector], n)
    same = (shard.rows[vector] == asked.rows[query]).all(axis=1)
    query, key, same = np.repeat(query, n), np.repeat(key, n), np.repeat(same, n)
    ids = shard.ids[at]
    own = np.flatnonzero(same & (ids == asked.ids[query]))
    own = own[np.unique(query[own], return_index=True)[1]]  # of equal rows one is its own
    query, key, ids = np.delete(query, own), np.delete(key, own), np.delete(ids, own)
    order = np.lexsort((ids, key, query))
    query, key, ids = query[order], key[order], ids[order]
    first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, dtype=np.int64)
    keep = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)])) < k
    return [query[keep], ids[keep], key[keep]]


def searched(rows: DataFrame, shards: DataFrame, every: int, k: int, floor: Callable[[np.ndarray], np.ndarray], each: Callable[[Shard, Round], list[np.ndarray]], kind: str, score: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(query_id, rank, vec_id, score): what ``each`` (query, id, key) finds in the shards for the rows of
    ``rows`` whose id is divisible by ``every``, the ``k`` least keys of each.

    ``floor`` gives the largest key that can matter for each query vector;
    ``score`` turns keys into scores of type ``kind``.
    """
    spark = rows.sparkSession
    asked = materialise(rows.where(F.col("vec_id") % every == 0).groupBy("vec_id", "v").agg(F.count("*").alias("times")), "queries")
    path = f"{shared_dir(spark)}/driftwell/found-{uuid.uuid4().hex}"
    schema = f"number long, query_id long, times long, vec_id long, score {kind}"
    spark.createDataFrame([], schema).write.parquet(path)
    for part in _rounds(asked, floor):
        told = spark.sparkContext.broadcast(part)

        def search(batches: Iterator[pa.RecordBatch], told=told) -> Iterator[pa.RecordBatch]:
            own = told.value
            for shard in _shards(batches):
                query, ids, key = each(shard, own)
                columns = [own.number[query], own.ids[query], own.times[query], ids, score(key)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["number", "query_id", "times", "vec_id", "score"])

        shards.mapInArrow(search, schema).write.mode("append").parquet(path)
        told.destroy()
    discard(asked)
    found = written(spark, path, schema)
    w = Window.partitionBy("number").orderBy(F.desc("score") if kind == "long" else F.asc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    best = best.withColumn("one", F.explode(F.expr("sequence(1L, times)")))  # equal rows ask the same
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
