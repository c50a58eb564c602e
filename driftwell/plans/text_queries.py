"""Queries of text retrieval and statistics, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.functions.columns import rounded
from driftwell.operators import retrieval as R
from driftwell.operators import stats as S
from driftwell.sources.tables import load

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
QUERY = ["the", "of", "and"]


def _chunks(spark, d):
    rows = R.chunks(load(spark, d, "documents").select("doc_id", "text"), "text")
    return rows.select("doc_id", "chunk_index", F.md5(F.col("chunk").cast("binary")).alias("digest"))


def _bm25(spark, d):
    return R.bm25(load(spark, d, "documents"), "doc_id", "text", QUERY, 20)


def _cosine(spark, d):
    return R.cosine_topk(load(spark, d, "embeddings"), "vec_id", "embedding", 100, 10)


def _fusion(spark, d):
    return R.fuse([R.bm25_each(load(spark, d, "documents"), "doc_id", "text", QUERY, 50)], 20)


def _moments(spark, d):
    return rounded(S.moments(load(spark, d, "lineitem"), NUMBERS, ["l_returnflag"]), 5)


def _outliers(spark, d):
    return S.without_outliers(load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"], 1.5)


def _clipped(spark, d):
    return rounded(S.clipped(load(spark, d, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"], 0.9))


def _corr(spark, d):
    return rounded(S.correlations(load(spark, d, "lineitem"), NUMBERS))


def _anova(spark, d):
    return rounded(S.anova(load(spark, d, "orders"), "o_orderpriority", "o_totalprice"), 5)


def _agreement(spark, d):
    e = load(spark, d, "embeddings").select("label", F.when(F.get("embedding", F.lit(0)) > 0, 1).otherwise(0).alias("sign"))
    return rounded(S.agreement(e, "label", "sign"))


QUERIES = {
    "text_chunks": _chunks, "bm25_topk": _bm25, "cosine_topk": _cosine, "rank_fusion": _fusion, "column_moments": _moments, "outlier_filter": _outliers,
    "outlier_clip": _clipped, "correlation_pairs": _corr, "anova_f": _anova, "label_agreement": _agreement,
}


def _bm25_sql(words: list[str], k: int) -> str:
    named = ", ".join(f"'{w}'" for w in words)
    return f"""(WITH r AS (SELECT doc_id AS id, list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS t FROM documents),
s AS (SELECT count(*) AS docs, avg(len(t)) AS mean FROM r), h AS (SELECT id, n, term, count(*) AS tf FROM (SELECT id, len(t) AS n, unnest(t) AS term FROM r) WHERE term IN ({named}) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM h GROUP BY term),
c AS (SELECT id, round(sum(ln(1 + (docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n / mean))), 9) AS score FROM h JOIN f USING (term), s GROUP BY id)
SELECT id, score, CAST(row_number() OVER (ORDER BY score DESC, id) AS INTEGER) AS rank FROM c ORDER BY score DESC, id LIMIT {k})"""


SQL = {
    "text_chunks": "SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, md5(c) AS digest FROM (SELECT doc_id, i, trim(substring(text, CAST(i * 1000 + 1 AS BIGINT), 1200), ' ') AS c FROM (SELECT doc_id, text, unnest(range(0, 1 + CAST(greatest(ceil((length(text) - 1200) / 1000), 0) AS BIGINT))) AS i FROM documents WHERE length(text) > 0)) WHERE length(c) > 0",
    "bm25_topk": f"SELECT * FROM {_bm25_sql(QUERY, 20)}",
    "cosine_topk": """WITH s AS (SELECT q.vec_id AS query_id, e.vec_id AS id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 9) AS score FROM embeddings e JOIN embeddings q ON q.vec_id % 100 = 0 AND e.vec_id <> q.vec_id),
      r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM s) SELECT * FROM r WHERE rank <= 10""",
    "rank_fusion": "SELECT id, round(sum(1 / (60 + rank)), 9) AS score FROM (" + " UNION ALL ".join(f"SELECT * FROM {_bm25_sql([w], 50)}" for w in QUERY) + ") GROUP BY id ORDER BY score DESC, id LIMIT 20",
    "column_moments": "SELECT l_returnflag, \"column\", count(*) AS n, " + ", ".join(f"round({e}, 5) + 0.0 AS {n}" for n, e in {"mean": "avg(value)", "std": "stddev_samp(value)", "low": "min(value)", "high": "max(value)", "p25": "quantile_cont(value, 0.25)", "median": "median(value)", "p75": "quantile_cont(value, 0.75)", "skew": "skewness(value)", "kurtosis": "kurtosis(value)"}.items()) + " FROM (UNPIVOT (SELECT l_returnflag, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem) ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME \"column\" VALUE value) GROUP BY ALL",
    "outlier_filter": "WITH s AS (SELECT avg(l_quantity) AS a, stddev_pop(l_quantity) AS b, avg(l_extendedprice) AS c, stddev_pop(l_extendedprice) AS d FROM lineitem) SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem, s WHERE abs(l_quantity - a) / b < 1.5 AND abs(l_extendedprice - c) / d < 1.5",
    "outlier_clip": "WITH s AS (SELECT quantile_cont(c_acctbal, 0.9) FILTER (c_acctbal > 0) AS h, quantile_cont(c_acctbal, 0.1) FILTER (c_acctbal < 0) AS l FROM customer) SELECT c_custkey, round(greatest(l, least(c_acctbal, h)), 6) + 0.0 AS c_acctbal FROM customer, s",
    "correlation_pairs": " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS r FROM lineitem" for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1 :]),
    "anova_f": "WITH g AS (SELECT count(o_totalprice) AS n, avg(o_totalprice) AS m, var_pop(o_totalprice) AS v FROM orders GROUP BY o_orderpriority), t AS (SELECT count(*) AS k, CAST(sum(n) AS BIGINT) AS n, sum(n * m) / sum(n) AS mean, sum(n * m * m) AS sq, sum(n * v) AS w FROM g) SELECT k, n, round(((sq - n * mean * mean) / (k - 1)) / (w / (n - k)), 5) + 0.0 AS f FROM t",
    "label_agreement": """WITH e AS (SELECT label, CASE WHEN embedding[1] > 0 THEN 1 ELSE 0 END AS sign FROM embeddings), c AS (SELECT label, sign, CAST(count(*) AS DOUBLE) AS n FROM e GROUP BY ALL),
      a AS (SELECT sum(n) AS n FROM c GROUP BY label), b AS (SELECT sum(n) AS n FROM c GROUP BY sign),
      o AS (SELECT (SELECT sum(n) FROM c) AS t, (SELECT sum(n * (n - 1) / 2) FROM c) AS ij, (SELECT sum(n * (n - 1) / 2) FROM a) AS sa, (SELECT sum(n * (n - 1) / 2) FROM b) AS sb, (SELECT sum(n * ln(n)) FROM a) AS la, (SELECT sum(n * ln(n)) FROM b) AS lb, (SELECT sum(n * ln(n)) FROM c) AS l)
      SELECT round((ij - sa * sb / (t * (t - 1) / 2)) / ((sa + sb) / 2 - sa * sb / (t * (t - 1) / 2)), 6) + 0.0 AS ari, round(((l - la - lb) / t + ln(t)) / (((ln(t) - la / t) + (ln(t) - lb / t)) / 2), 6) + 0.0 AS nmi FROM o""",
}
