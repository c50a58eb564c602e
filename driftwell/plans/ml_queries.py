"""Queries of scaling, selection, tests and scores, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.functions.columns import rounded
from driftwell.operators import ml as L
from driftwell.operators.prep import in_currency
from driftwell.sources.tables import load

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
WEIGHTS, RATES = {"l_quantity": 0.5, "l_discount": 0.3, "l_tax": -0.2}, {"l_quantity": 0.5, "l_discount": 0.0, "l_tax": 1.0}


def _lines(spark, d):
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *NUMBERS)


def _selection(spark, d):
    rows = _lines(spark, d).withColumns({"quantity_mean": F.col("l_quantity") * 2, "price_unit": F.col("l_extendedprice") / F.col("l_quantity"), "tax_twice": F.col("l_tax") * 2 + F.col("l_discount") / 1000})
    names = [*NUMBERS, "quantity_mean", "price_unit", "tax_twice"]
    drop, kept = L.uncorrelated(rows, names, 0.9)
    return spark.createDataFrame([(n, n in drop, n in kept) for n in names], "column string, dropped boolean, kept boolean")


def _filled(spark, d):
    rows = _lines(spark, d).select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("l_quantity"))
    return L.median_filled(rows, ["l_quantity"])


def _risk(spark, d):
    rows = _lines(spark, d).withColumn("currency", F.when(F.col("l_orderkey") % 2 == 0, "USD").otherwise("CNY"))
    out = L.risk_score(rows, WEIGHTS, RATES, 0.1, in_currency(F.col("l_extendedprice"), F.col("currency"), {"USD": 7.0}), 200_000)
    return rounded(out.select("l_orderkey", "l_linenumber", "linear_score", "is_risk_score", "meets_profit", "is_risk"), 9)


def _two_way(spark, d):
    return rounded(L.two_way(load(spark, d, "lineitem"), "l_returnflag", "l_linestatus", "l_quantity"), 3)


QUERIES = {
    "standard_scaling": lambda s, d: rounded(L.standard_scaled(_lines(s, d), NUMBERS)),
    "range_scaling": lambda s, d: rounded(L.range_scaled(_lines(s, d), NUMBERS)),
    "median_fill": _filled,
    "power_transform": lambda s, d: rounded(L.powered(_lines(s, d).withColumn("l_quantity", F.col("l_quantity") - 25), {"l_quantity": 0.5, "l_discount": 2.0, "l_tax": 0.0}), 9),
    "drop_outliers": lambda s, d: L.drop_outliers(_lines(s, d), ["l_quantity", "l_extendedprice"], 1.2),
    "variance_threshold": lambda s, d: rounded(L.variances(_lines(s, d), NUMBERS), 4),
    "correlation_selection": _selection,
    "spearman": lambda s, d: rounded(L.spearman(_lines(s, d), "l_quantity", "l_extendedprice")),
    "kruskal_h": lambda s, d: rounded(L.kruskal(load(s, d, "lineitem"), "l_returnflag", "l_quantity"), 5),
    "two_way_anova": _two_way,
    "risk_score": _risk,
}

_R = lambda e, n, p=6: f"round(CAST({e} AS DOUBLE), {p}) + 0.0 AS {n}"
_KEY = "l_orderkey, l_linenumber"
_M = f"m AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}, stddev_samp({c}) AS d_{c}, min({c}) AS l_{c}, max({c}) AS h_{c}' for c in NUMBERS)} FROM lineitem)"
_RANK = lambda c: f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2"
_POWER = {"l_quantity": "(sqrt(l_quantity + 1) - 1) / 0.5::DOUBLE", "l_discount": "ln(l_discount + 1)", "l_tax": "l_tax"}
_ALL = [*NUMBERS, "quantity_mean", "price_unit", "tax_twice"]
SQL = {
    "standard_scaling": f"WITH {_M} SELECT {_KEY}, {', '.join(_R(f'({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END', c) for c in NUMBERS)} FROM lineitem, m",
    "range_scaling": f"WITH {_M} SELECT {_KEY}, {', '.join(_R(f'coalesce(({c} - l_{c}) / nullif(h_{c} - l_{c}, 0), 0)', c) for c in NUMBERS)} FROM lineitem, m",
    "median_fill": f"WITH r AS (SELECT {_KEY}, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS q FROM lineitem), m AS (SELECT median(q) AS med FROM r) SELECT {_KEY}, coalesce(q, med) AS l_quantity FROM r, m",
    "power_transform": f"""SELECT {_KEY}, {_R("CASE WHEN l_quantity >= 25 THEN (sqrt(l_quantity - 24) - 1) / 0.5::DOUBLE ELSE -(pow(26 - l_quantity, 1.5::DOUBLE) - 1) / 1.5::DOUBLE END", "l_quantity", 9)}, l_extendedprice, {_R("(pow(l_discount + 1, 2) - 1) / 2", "l_discount", 9)}, {_R("ln(l_tax + 1)", "l_tax", 9)} FROM lineitem""",
    "drop_outliers": f"WITH {_M} SELECT {_KEY}, {', '.join(NUMBERS)} FROM lineitem, m WHERE abs(l_quantity - m_l_quantity) <= 1.2::DOUBLE * d_l_quantity AND abs(l_extendedprice - m_l_extendedprice) <= 1.2::DOUBLE * d_l_extendedprice",
    "variance_threshold": " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {_R(f'var_pop({c})', 'variance', 4)}, var_pop({c}) > 0.01 AS kept FROM lineitem" for c in NUMBERS),
    "correlation_selection": f"""WITH r AS (SELECT *, l_quantity * 2 AS quantity_mean, l_extendedprice / l_quantity AS price_unit, l_tax * 2 + l_discount / 1000 AS tax_twice FROM lineitem),
      p AS ({" UNION ALL ".join(f"SELECT {i} AS a, {j} AS b, abs(corr({_ALL[i]}, {_ALL[j]})) > 0.9 AS high FROM r" for j in range(len(_ALL)) for i in range(j))}),
      n AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{c}', {'mean' in c or 'median' in c})" for i, c in enumerate(_ALL))}) t(i, name, wanted)),
      g AS (SELECT b AS own, a AS member FROM p WHERE high UNION ALL SELECT i, i FROM n),
      k AS (SELECT own, coalesce(min(CASE WHEN wanted THEN CASE WHEN member = own THEN -1 ELSE member END END), -1) AS best FROM g JOIN n ON n.i = g.member GROUP BY own),
      e AS (SELECT own, CASE WHEN best = -1 THEN own ELSE best END AS best FROM k)
      SELECT name AS "column", i IN (SELECT member FROM g JOIN e USING (own) WHERE member <> best) AS dropped, i IN (SELECT best FROM e) AS kept FROM n""",
    "spearman": f"WITH r AS (SELECT {_RANK('l_quantity')} AS a, {_RANK('l_extendedprice')} AS b FROM lineitem) SELECT count(*) AS n, {_R('corr(a, b)', 'rho')} FROM r",
    "kruskal_h": f"""WITH r AS (SELECT l_returnflag AS g, {_RANK("l_quantity")} AS r, count(*) OVER (PARTITION BY l_quantity) AS t FROM lineitem), o AS (SELECT g, count(*) AS n, sum(r) AS s, sum(CAST(t AS DOUBLE) * t - 1) AS t FROM r GROUP BY g),
      x AS (SELECT count(*) AS k, CAST(sum(n) AS BIGINT) AS n, sum(s * s / n) AS q, sum(t) AS t FROM o) SELECT k, n, {_R("(12 / (CAST(n AS DOUBLE) * (n + 1)) * q - 3 * (n + 1)) / (1 - t / (CAST(n AS DOUBLE) * n * n - n))", "h", 5)} FROM x""",
    "two_way_anova": f"""WITH c AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*) AS n, sum(l_quantity) AS s, sum(l_quantity * l_quantity) AS q FROM lineitem GROUP BY ALL), t AS (SELECT sum(n) AS n, sum(s) * sum(s) / sum(n) AS m, sum(q) AS q, sum(s * s / n) AS c, count(*) AS k FROM c),
      x AS (SELECT sum(s * s / n) AS c, count(*) AS k FROM (SELECT sum(n) AS n, sum(s) AS s FROM c GROUP BY a)), y AS (SELECT sum(s * s / n) AS c, count(*) AS k FROM (SELECT sum(n) AS n, sum(s) AS s FROM c GROUP BY b)),
      e AS (SELECT 'l_returnflag' AS effect, x.c - m AS ss, x.k - 1 AS df FROM t, x UNION ALL SELECT 'l_linestatus', y.c - m, y.k - 1 FROM t, y UNION ALL SELECT 'l_returnflag:l_linestatus', t.c - x.c - y.c + m, (x.k - 1) * (y.k - 1) FROM t, x, y)
      SELECT effect, {_R("ss", "ss", 3)}, CAST(df AS BIGINT) AS df, {_R("(ss / nullif(df, 0)) / ((t.q - t.c) / (t.n - t.k))", "f", 3)} FROM e, t UNION ALL SELECT 'error', {_R("q - c", "ss", 3)}, CAST(n - k AS BIGINT), NULL FROM t""",
    "risk_score": f"""WITH p AS (SELECT {_KEY}, l_extendedprice * CASE WHEN l_orderkey % 2 = 0 THEN 7 ELSE 1 END AS profit, {", ".join(f"{e} AS {c}" for c, e in _POWER.items())} FROM lineitem), m AS (SELECT {", ".join(f"min({c}) AS l_{c}, max({c}) AS h_{c}" for c in WEIGHTS)} FROM p),
      s AS (SELECT {_KEY}, profit, 0.1::DOUBLE + {" + ".join(f"coalesce(({c} - l_{c}) / nullif(h_{c} - l_{c}, 0), 0) * ({w}::DOUBLE)" for c, w in WEIGHTS.items())} AS linear FROM p, m), q AS (SELECT quantile_cont(linear, 0.9) AS lim FROM s)
      SELECT {_KEY}, {_R("linear", "linear_score", 9)}, linear > lim AS is_risk_score, profit >= 200000 AS meets_profit, linear > lim AND profit >= 200000 AS is_risk FROM s, q""",
}
