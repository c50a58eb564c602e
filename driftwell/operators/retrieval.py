"""Text chunks and their retrieval by keywords and vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chunks(df: DataFrame, text: str, size: int = 1200, overlap: int = 200) -> DataFrame:
    """Windows of ``size`` characters, ``overlap`` of them shared; blank ones are left out but keep their number."""
    step = size - overlap
    n = F.length(text)
    last = F.greatest(F.ceil((n - size) / step), F.lit(0)).cast("int")
    out = df.where(n > 0).withColumn("chunk_index", F.explode(F.sequence(F.lit(0), last)))
    out = out.withColumn("chunk", F.trim(F.substring(F.col(text), F.col("chunk_index") * step + 1, F.lit(size))))
    return out.where(F.length("chunk") > 0)


def _top(df: DataFrame, by: list[str], k: int, score: str, tie: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(tie))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^a-z0-9]+", -1), lambda x: x != "")


def _scored(df: DataFrame, id_col: str, text: str, query: list[str], k1: float, b: float) -> DataFrame:
    """(id, term, part) of each row and query term that it holds; statistics are of all rows, in one pass over them.

    Other terms are dropped before anything is exploded."""
    rows = df.select(F.col(id_col).alias("id"), terms(F.col(text)).alias("terms"))
    rows = rows.select("id", F.size("terms").alias("len"), F.filter("terms", lambda t: t.isin(*query)).alias("own"))
    stats = rows.agg(F.count("*").alias("docs"), F.avg("len").alias("mean"))
    hits = rows.where(F.size("own") > 0).select("id", "len", F.explode("own").alias("term")).groupBy("id", "len", "term").agg(F.count("*").alias("tf"))
    held = hits.groupBy("term").agg(F.count("*").alias("df"))  # a row a query term
    all_ = hits.join(F.broadcast(held), "term").crossJoin(F.broadcast(stats))  # one row
    idf = F.log(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return all_.select("id", "term", (idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("mean")))).alias("part"))


def bm25(df: DataFrame, id_col: str, text: str, query: list[str], k: int, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """The ``k`` best rows for the query's terms."""
    scored = _scored(df, id_col, text, query, k1, b).groupBy("id").agg(F.round(F.sum("part"), 9).alias("score"))
    place = F.row_number().over(Window.orderBy(F.desc("score"), F.asc("id")))
    return scored.orderBy(F.desc("score"), F.asc("id")).limit(k).withColumn("rank", place)


def bm25_each(df: DataFrame, id_col: str, text: str, query: list[str], k: int, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """(term, id, score, rank): the ``k`` best rows for each term alone, in one scan."""
    return _top(_scored(df, id_col, text, query, k1, b).select("term", "id", F.round("part", 9).alias("score")), ["term"], k, "score", "id")


#: Queries that meet all rows at once.
BLOCK = 1_024


def cosine_topk(df: DataFrame, id_col: str, vector: str, every: int, k: int) -> DataFrame:
    """The ``k`` nearest other rows by cosine of each row whose id is divisible by ``every``.

    Queries come in blocks of ``BLOCK`` or fewer (a checked size), each broadcast
    against all rows; the best of a task are chosen before the shuffle.  Null and
    zero vectors take no part."""
    v = F.col(vector).cast("array<double>")
    rows = df.select(F.col(id_col).alias("id"), v.alias("v")).withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).where("norm > 0")
    asked = rows.where(F.col("id") % every == 0)
    n = asked.count()
    blocks = max(1, -(-n // BLOCK))
    asked = asked.select(F.col("id").alias("query_id"), F.col("v").alias("q"), F.col("norm").alias("q_norm"))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)) + 1)
    dot = F.aggregate(F.zip_with("v", "q", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    out = None
    for i in range(1, blocks + 1):
        pairs = rows.join(F.broadcast(asked.where(F.col("block") == i)), F.col("id") != F.col("query_id"))  # about BLOCK queries
        best = _top(pairs.select("query_id", "id", F.round(dot / (F.col("norm") * F.col("q_norm")), 9).alias("score")), ["query_id"], k, "score", "id")
        out = best if out is None else out.unionByName(best)
    return out


def fuse(lists: list[DataFrame], k: int, constant: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of lists (id, rank)."""
    rows = lists[0].select("id", "rank")
    for more in lists[1:]:
        rows = rows.unionByName(more.select("id", "rank"))
    scored = rows.groupBy("id").agg(F.round(F.sum(1 / (F.lit(constant) + F.col("rank"))), 9).alias("score"))
    return scored.orderBy(F.desc("score"), F.asc("id")).limit(k)
