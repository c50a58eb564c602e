"""Connected components of an edge table by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.llm.store import discard, materialise


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) to (node, component): the smallest node reachable.

    Only nodes of edges between two different nodes appear.  Every round is
    two joins and two aggregations that combine before they shuffle; a hub's
    rows in a join are split by AQE.  Each round is written to the shared
    folder, and the driver sees only a count and a checksum.
    """
    lesser, greater = F.least("u", "v"), F.greatest("u", "v")
    now = materialise(edges.where("u <> v").select(greater.alias("u"), lesser.alias("v")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # now every row has v < u: the small star of u links its lesser neighbours to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        after = materialise(small.where("u <> v").distinct(), "edges")
        discard(now)
        before, mark, now = mark, _mark(after), after
        if before == mark:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
