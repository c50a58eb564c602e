"""Scaling, selection, tests and clusters of numeric columns.

Whatever grows with the rows is an aggregation or a join; what reaches the
driver has the size of the columns or of a parameter.
"""

from __future__ import annotations

from math import asin, atan, exp, lgamma, log, sqrt
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.functions.columns import ratio


def _beside(df: DataFrame, aggs: list[Column]) -> DataFrame:
    return df.crossJoin(F.broadcast(df.agg(*aggs)))  # one row


# ---------------------------------------------------------------------- scaling


def standard_scaled(df: DataFrame, columns: list[str]) -> DataFrame:
    """z-scores by population deviations; a deviation of 0 counts as 1."""
    out = _beside(df, [f(c).alias(f"__{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    spread = lambda c: F.when(F.col(f"__s_{c}") == 0, 1.0).otherwise(F.col(f"__s_{c}"))
    return out.select(*(((F.col(c) - F.col(f"__m_{c}")) / spread(c)).alias(c) if c in columns else F.col(c) for c in df.columns))


def range_scaled(df: DataFrame, columns: list[str]) -> DataFrame:
    """0 at the smallest value and 1 at the largest; a constant column is 0."""
    out = _beside(df, [f(c).alias(f"__{n}_{c}") for c in columns for n, f in (("l", F.min), ("h", F.max))])
    scaled = lambda c: F.when(F.col(c).isNotNull(), F.coalesce(ratio(F.col(c) - F.col(f"__l_{c}"), F.col(f"__h_{c}") - F.col(f"__l_{c}")), F.lit(0.0)))
    return out.select(*(scaled(c).alias(c) if c in columns else F.col(c) for c in df.columns))


def median_filled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls as the column's median, or 0 where it has none."""
    out = _beside(df, [F.median(c).alias(f"__{c}") for c in columns])
    return out.select(*(F.coalesce(c, f"__{c}", F.lit(0.0)).alias(c) if c in columns else F.col(c) for c in df.columns))


def drop_outliers(df: DataFrame, columns: list[str], z: float) -> DataFrame:
    """Rows within ``z`` sample deviations of every column's mean; null values go, and so does all where a column has no deviation."""
    out = _beside(df, [f(c).alias(f"__{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    keep = F.lit(True)
    for c in columns:
        keep = keep & (F.abs(F.col(c) - F.col(f"__m_{c}")) <= z * F.col(f"__s_{c}"))
    return out.where(keep).select(*df.columns)


def power(x: Column, rate: float) -> Column:
    """The Yeo-Johnson transform; zero stays zero."""
    up = F.log1p(F.greatest(x, F.lit(0.0))) if rate == 0 else (F.pow(F.greatest(x, F.lit(0.0)) + 1, F.lit(rate)) - 1) / rate
    low = -F.log1p(F.greatest(-x, F.lit(0.0))) if rate == 2 else -(F.pow(F.greatest(-x, F.lit(0.0)) + 1, F.lit(2 - rate)) - 1) / (2 - rate)
    return F.when(x >= 0, up).otherwise(F.when(x < 0, low))


def power_rates(df: DataFrame, columns: list[str], low: float = -3.0, high: float = 3.0, steps: int = 32) -> dict[str, float]:
    """Each column's likeliest rate, by golden section: a step is one aggregation over all columns."""
    golden = (5**0.5 - 1) / 2
    ends = {c: [low, high] for c in columns}
    one = df.agg(*(F.sum(F.signum(c) * F.log1p(F.abs(c))).alias(c) for c in columns), *(F.count(c).alias(f"n_{c}") for c in columns)).first()

    def score(rates: dict[str, list[float]]) -> dict[str, list[float]]:
        row = df.agg(*(F.var_pop(power(F.col(c).cast("double"), r)).alias(f"{c}_{i}") for c in columns for i, r in enumerate(rates[c]))).first()
        return {c: [-0.5 * np.log(max(row[f"{c}_{i}"] or 0.0, 1e-300)) + (r - 1) * (one[c] or 0.0) / max(1, one[f"n_{c}"]) for i, r in enumerate(rates[c])] for c in columns}

    for _ in range(steps):
        inner = {c: [b - golden * (b - a), a + golden * (b - a)] for c, (a, b) in ends.items()}
        got = score(inner)
        for c in columns:
            ends[c] = [ends[c][0], inner[c][1]] if got[c][0] >= got[c][1] else [inner[c][0], ends[c][1]]
    return {c: (a + b) / 2 for c, (a, b) in ends.items()}


def powered(df: DataFrame, rates: dict[str, float], suffix: str = "") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": power(F.col(c).cast("double"), r) for c, r in rates.items()})


# -------------------------------------------------------------------- selection


def variances(df: DataFrame, columns: list[str], threshold: float = 0.01) -> DataFrame:
    """(column, variance, kept): population variances, kept above the threshold."""
    one = df.agg(F.array(*(F.struct(F.lit(c).alias("column"), F.var_pop(c).alias("variance")) for c in columns)).alias("all"))
    return one.select(F.inline("all")).withColumn("kept", F.col("variance") > threshold)


def uncorrelated(df: DataFrame, columns: list[str], threshold: float = 0.9, prefer: tuple[str, ...] = ("mean", "median")) -> tuple[list[str], list[str]]:
    """Columns to drop and to keep: of each column and those before it with |r| above the threshold one stays,
    the first whose name holds a preferred word, else the column itself.  A column may be named on both lists."""
    pairs = [(a, b) for i, b in enumerate(columns) for a in columns[:i]]
    row = df.agg(*(F.corr(a, b) for a, b in pairs)).first() if pairs else ()
    high = {p for p, r in zip(pairs, row) if r is not None and abs(r) > threshold}
    drop: set[str] = set()
    kept: set[str] = set()
    for i, c in enumerate(columns):
        group = [c, *(a for a in columns[:i] if (a, c) in high)]
        best = next((x for x in group if any(w in x.lower() for w in prefer)), c) if len(group) > 1 else c
        kept.add(best)
        drop |= {x for x in group if x != best}
    return sorted(drop), sorted(kept)


def principal(df: DataFrame, columns: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, variances along the components (largest first) and components as rows, whose largest loading is positive."""
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1)]
    row = df.agg(*(F.avg(c) for c in columns), *(F.covar_samp(columns[i], columns[j]) for i, j in pairs)).first()
    cov = np.zeros((len(columns),) * 2)
    for (i, j), v in zip(pairs, row[len(columns) :]):
        cov[i, j] = cov[j, i] = v or 0.0
    values, vectors = np.linalg.eigh(cov)
    parts = vectors.T[::-1]
    parts = parts * np.sign(parts[np.arange(len(parts)), np.abs(parts).argmax(axis=1)])[:, None]
    return np.array([x or 0.0 for x in row[: len(columns)]]), values[::-1], parts


def with_components(df: DataFrame, columns: list[str], n: int) -> DataFrame:
    """``df`` and the first ``n`` principal components of its scaled columns, pc1 and so on."""
    scaled = standard_scaled(df.select("*", *(F.col(c).alias(f"__x_{c}") for c in columns)), [f"__x_{c}" for c in columns])
    mean, _, parts = principal(scaled, [f"__x_{c}" for c in columns])
    dot = lambda p: sum(((F.col(f"__x_{c}") - float(m)) * float(w) for c, m, w in zip(columns, mean, p)), F.lit(0.0))
    return scaled.withColumns({f"pc{i + 1}": dot(p) for i, p in enumerate(parts[:n])}).drop(*(f"__x_{c}" for c in columns))


def importance(df: DataFrame, columns: list[str]) -> list[tuple[str, float]]:
    """Columns by the sum of their absolute loadings on all components, the largest first, ties by name."""
    _, _, parts = principal(df, columns)
    return sorted(zip(columns, np.abs(parts).sum(axis=0).tolist()), key=lambda x: (-x[1], x[0]))


# ------------------------------------------------------------------------ tests


def ranked(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with the mean rank of each value among all rows, from 1; null values have none.

    Distinct values are counted, put in ranges, and ranked range by range, so no task sees them all."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("__v")).agg(F.count("*").alias("__n"))
    placed = counts.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "__v").withColumn("__p", F.spark_partition_id())
    sums = placed.groupBy("__p").agg(F.sum("__n").alias("__s"))
    before = F.coalesce(F.sum("__s").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a partition
    upto = F.sum("__n").over(Window.partitionBy("__p").orderBy("__v"))
    ranks = placed.join(F.broadcast(sums.select("__p", before.alias("__b"))), "__p").select("__v", (F.col("__b") + upto - (F.col("__n") - 1) / 2).alias(name), F.col("__n").alias(f"{name}_ties"))
    return df.join(ranks, df[column] == ranks["__v"], "left").drop("__v")


def _beta_tail(x: float, a: float, b: float) -> float:
    """The regularised incomplete beta function, by the integral over a fine grid of its smooth form.

    With t = sin(u) ** 2 the integrand has no pole for a, b of a half or more."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    edge = asin(sqrt(x))
    nodes, weights = np.polynomial.legendre.leggauss(200)

    def part(low: float, high: float) -> float:
        u = (high - low) / 2 * nodes + (high + low) / 2
        return float((high - low) / 2 * (weights * 2 * np.exp((2 * a - 1) * np.log(np.sin(u)) + (2 * b - 1) * np.log(np.cos(u)) - lbeta)).sum())

    lbeta = lgamma(a) + lgamma(b) - lgamma(a + b)
    peak = atan(sqrt(max(2 * a - 1, 1e-9) / max(2 * b - 1, 1e-9)))  # where the integrand is largest
    width = 12 / sqrt(max(4 * (a + b), 1.0))
    cuts = sorted({0.0, edge, *(min(edge, max(0.0, peak + k * width)) for k in (-1, -0.25, 0, 0.25, 1))})
    return min(1.0, sum(part(p, q) for p, q in zip(cuts, cuts[1:])))


def f_tail(f: float, top: float, bottom: float) -> float:
    """The probability of an F statistic of ``f`` or more."""
    return _beta_tail(bottom / (bottom + top * f), bottom / 2, top / 2) if f > 0 else 1.0


def t_tails(t: float, free: float) -> float:
    """The probability of a t statistic that far from 0 on either side."""
    return f_tail(t * t, 1, free)


def chi2_tail(x: float, free: float) -> float:
    """The probability of a chi-squared statistic of ``x`` or more, by the series of the lower part."""
    if x <= 0:
        return 1.0
    a, z = free / 2, x / 2
    term = total = 1 / a
    n = a
    while abs(term) > abs(total) * 1e-15 and n < a + 5_000:
        n += 1
        term *= z / n
        total += term
    return max(0.0, 1 - total * exp(-z + a * log(z) - lgamma(a)))


def _normal(x: np.ndarray) -> np.ndarray:
    """The normal distribution function, by a fine table of its integral."""
    return np.interp(x, _GRID, _BELOW, left=0.0, right=1.0)


_GRID = np.linspace(-9, 9, 36_001)
_BELOW = np.concatenate([[0.0], np.cumsum((np.exp(-(_GRID[1:] ** 2) / 2) + np.exp(-(_GRID[:-1] ** 2) / 2)) / 2)]) * (_GRID[1] - _GRID[0]) / sqrt(2 * np.pi)


def range_tail(q: float, groups: int, free: float) -> float:
    """The probability of a studentized range of ``q`` or more."""
    z = np.linspace(-8, 8, 801)
    density = np.exp(-(z**2) / 2) / sqrt(2 * np.pi)
    low, high = (max(1e-6, 1 - 9 / sqrt(2 * free)), 1 + 9 / sqrt(2 * free) + 3 / free) if free < 1e5 else (1.0, 1.0)
    s = np.linspace(low, high, 401)
    inner = np.array([groups * np.trapezoid(density * (_normal(z) - _normal(z - q * x)) ** (groups - 1), z) for x in s])
    if low == high:
        return float(1 - inner[0])
    weight = np.exp(free / 2 * log(free) - lgamma(free / 2) - (free / 2 - 1) * log(2) + (free - 1) * np.log(s) - free * s**2 / 2)
    return float(min(1.0, max(0.0, 1 - np.trapezoid(weight * inner, s) / np.trapezoid(weight, s))))


def anova_test(df: DataFrame, group: str, value: str) -> tuple[float, float]:
    """One-way F and its probability, from the groups' sums."""
    g = _groups(df, group, value)
    n, k = g.n.sum(), len(g)
    between, within = (g.n * (g["mean"] - (g.n * g["mean"]).sum() / n) ** 2).sum(), (g["var"] * (g.n - 1)).sum()
    f = float(between / (k - 1) / (within / (n - k)))
    return f, f_tail(f, k - 1, n - k)


def _groups(df: DataFrame, group: str, value: str) -> pd.DataFrame:
    """(group, n, mean, var) of the groups of two values or more: a row for each group."""
    own = df.where(F.col(value).isNotNull()).groupBy(F.col(group).alias("group")).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("var"))
    return pd.DataFrame([r.asDict() for r in own.where("n > 1").orderBy("group").collect()], columns=["group", "n", "mean", "var"])


def post_hoc(df: DataFrame, group: str, value: str) -> pd.DataFrame:
    """(a, b, diff, p_tukey, p_games_howell, p_sidak) of each pair of groups.

    Tukey's and Sidak's pool the variances, Sidak's are t-tests corrected for the number of pairs; Games and Howell's take each pair's own."""
    g = _groups(df, group, value)
    n, k = int(g.n.sum()), len(g)
    pooled, pairs = float((g["var"] * (g.n - 1)).sum() / (n - k)) if n > k else float("nan"), k * (k - 1) // 2
    out = []
    for i in range(k):
        for j in range(i + 1, k):
            a, b = g.iloc[i], g.iloc[j]
            diff = float(a["mean"] - b["mean"])
            spread = sqrt(pooled * (1 / a.n + 1 / b.n))
            va, vb = a["var"] / a.n, b["var"] / b.n
            free = float((va + vb) ** 2 / (va**2 / (a.n - 1) + vb**2 / (b.n - 1)))
            out.append((a["group"], b["group"], diff, range_tail(abs(diff) / spread * sqrt(2), k, n - k), range_tail(abs(diff) / sqrt((va + vb) / 2), k, free), 1 - (1 - t_tails(diff / spread, n - k)) ** pairs))
    return pd.DataFrame(out, columns=["a", "b", "diff", "p_tukey", "p_games_howell", "p_sidak"])


def correlation_tests(df: DataFrame, columns: list[str], without_zeros: bool = False) -> pd.DataFrame:
    """(a, b, r, n, p) of each pair of columns over the rows that have both (and no 0, if asked); p is two-sided."""
    fine = lambda a, b: F.col(a).isNotNull() & F.col(b).isNotNull() & ((F.col(a) != 0) & (F.col(b) != 0) if without_zeros else F.lit(True))
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = df.agg(*(x for a, b in pairs for x in (F.corr(F.when(fine(a, b), F.col(a)), F.when(fine(a, b), F.col(b))), F.count(F.when(fine(a, b), 1))))).first()
    out = []
    for i, (a, b) in enumerate(pairs):
        r, n = row[2 * i], row[2 * i + 1]
        p = float("nan") if r is None or n < 3 else 0.0 if abs(r) >= 1 else t_tails(r * ((n - 2) / (1 - r * r)) ** 0.5, n - 2)
        out.append((a, b, r, n, p))
    return pd.DataFrame(out, columns=["a", "b", "r", "n", "p"])


def stars(p: float) -> str:
    return "***" if p < 0.001 else "**" if p < 0.01 else "*" if p < 0.05 else ""


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """The correlation of the mean ranks of two columns, over rows that have both."""
    both = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b)
    return ranked(ranked(both, a, "ra"), b, "rb").agg(F.count("*").alias("n"), F.corr("ra", "rb").alias("rho"))


def kruskal(df: DataFrame, group: str, value: str) -> DataFrame:
    """H over the groups' mean ranks, corrected for ties, and its degrees of freedom."""
    rows = ranked(df.where(F.col(value).isNotNull()).select(group, value), value, "r")
    own = rows.groupBy(group).agg(F.count("*").alias("n"), F.sum("r").alias("s"), F.sum(F.col("r_ties").cast("double") ** 2 - 1).alias("t"))
    one = own.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("s") ** 2 / F.col("n")).alias("q"), F.sum("t").alias("t"))
    n = F.col("n").cast("double")
    h = 12 / (n * (n + 1)) * F.col("q") - 3 * (n + 1)
    return one.select("k", "n", (h / F.nullif(1 - F.col("t") / (n * n * n - n), F.lit(0.0))).alias("h"))


def two_way(df: DataFrame, a: str, b: str, value: str) -> DataFrame:
    """(effect, ss, df, f) of two factors and their interaction, from cell sums; exact where all cells are as large."""
    cells = df.where(F.col(value).isNotNull()).groupBy(a, b).agg(F.count("*").alias("n"), F.sum(value).alias("s"), F.sum(F.col(value) * F.col(value)).alias("q"))
    total = cells.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.col("s") ** 2 / F.col("n")).alias("c"), F.count("*").alias("k"))
    side = lambda x, p: cells.groupBy(x).agg(F.sum("n").alias("n"), F.sum("s").alias("s")).agg(F.sum(F.col("s") ** 2 / F.col("n")).alias(f"{p}_c"), F.count("*").alias(f"{p}_k"))
    one = total.crossJoin(side(a, "a")).crossJoin(side(b, "b"))  # one row each
    mean = F.col("s") ** 2 / F.col("n")
    ss = {a: F.col("a_c") - mean, b: F.col("b_c") - mean, f"{a}:{b}": F.col("c") - F.col("a_c") - F.col("b_c") + mean}
    free = {a: F.col("a_k") - 1, b: F.col("b_k") - 1, f"{a}:{b}": (F.col("a_k") - 1) * (F.col("b_k") - 1)}
    error, left = F.col("q") - F.col("c"), F.col("n") - F.col("k")
    rows = [F.struct(F.lit(e).alias("effect"), ss[e].alias("ss"), free[e].cast("long").alias("df"), ratio(ratio(ss[e], free[e]), ratio(error, left)).alias("f")) for e in ss]
    rows.append(F.struct(F.lit("error").alias("effect"), error.alias("ss"), left.cast("long").alias("df"), F.lit(None).cast("double").alias("f")))
    return one.select(F.inline(F.array(*rows)))


# --------------------------------------------------------------------- clusters


def _vectors(df: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="__features", handleInvalid="skip").transform(df)


def fit_clusters(df: DataFrame, columns: list[str], k: int, kind: str = "kmeans", seed: int = 42):
    """A fitted k-means (or bisecting) model of the columns; rows with a null are left out."""
    maker = {"kmeans": KMeans, "bisecting": BisectingKMeans}[kind]
    return maker(k=k, seed=seed, featuresCol="__features", predictionCol="cluster").fit(_vectors(df, columns))


def apply_clusters(model, df: DataFrame, columns: list[str]) -> DataFrame:
    return model.transform(_vectors(df, columns)).drop("__features")


def elbow(df: DataFrame, columns: list[str], ks: list[int], kind: str = "kmeans", seed: int = 42) -> pd.DataFrame:
    """(k, inertia, silhouette, smallest, largest) of a model for each number of clusters."""
    rows = _vectors(df, columns)
    judge = ClusteringEvaluator(featuresCol="__features", predictionCol="cluster")
    out = []
    for k in ks:
        model = fit_clusters(df, columns, k, kind, seed)
        found = model.transform(rows)
        sizes = [r["count"] for r in found.groupBy("cluster").count().collect()]  # k numbers
        out.append((k, model.summary.trainingCost, judge.evaluate(found) if len(sizes) > 1 else float("nan"), min(sizes), max(sizes)))
    return pd.DataFrame(out, columns=["k", "inertia", "silhouette", "smallest", "largest"])


def attach_labels(events: DataFrame, labels: DataFrame, keys: list[str], label: str = "cluster") -> DataFrame:
    """Events with the label of their bin; a bin that is labelled twice has its least label, events without a bin go."""
    one = labels.groupBy(*keys).agg(F.min(label).alias(label))
    return events.join(one, keys)


def dbscan(df: DataFrame, key: str, columns: list[str], eps: float, least: int) -> DataFrame:
    """(key, cluster): density clusters by Euclidean distance ``eps`` with ``least`` points (itself one); noise is null.

    Points meet those of their own and the neighbouring cells of a grid of
    ``eps`` in the first two columns.  A cluster is named by its least core key;
    a border point joins the least cluster near it.  Each round of the
    components is cut off by ``checkpoint()`` in the session's folder.
    """
    grid = columns[:2]
    cell = lambda c: F.floor(F.col(c) / eps)
    rows = df.dropna(subset=columns).select(F.col(key).alias("k"), *(F.col(c).cast("double").alias(c) for c in columns), *(cell(c).alias(f"g{i}") for i, c in enumerate(grid)))
    around = rows
    for i in range(len(grid)):
        around = around.withColumn(f"g{i}", F.explode(F.array(*(F.col(f"g{i}") + d for d in (-1, 0, 1)))))
    other = around.select(F.col("k").alias("j"), *(F.col(c).alias(f"o_{c}") for c in columns), *(f"g{i}" for i in range(len(grid))))
    far = sum(((F.col(c) - F.col(f"o_{c}")) ** 2 for c in columns), F.lit(0.0))
    near = rows.join(other, [f"g{i}" for i in range(len(grid))]).where(far <= eps * eps).select("k", "j")
    core = near.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("k")
    near = near.join(core.withColumnRenamed("k", "j"), "j").checkpoint()  # neighbours that are core
    links = near.join(core, "k", "left_semi").checkpoint()
    label = core.withColumn("cluster", F.col("k")).checkpoint()
    while True:
        told = links.join(label.withColumnRenamed("k", "j"), "j").groupBy("k").agg(F.min("cluster").alias("least"))
        short = label.select(F.col("k").alias("cluster"), F.col("cluster").alias("up"))  # a label's own label
        after = label.join(told, "k").select("k", F.least("cluster", "least").alias("cluster")).join(short, "cluster").select("k", F.least("cluster", "up").alias("cluster")).checkpoint()
        moved = after.join(label.withColumnRenamed("cluster", "was"), "k").where("cluster <> was").isEmpty()
        label = after
        if moved:
            break
    best = near.join(label.withColumnRenamed("k", "j"), "j").groupBy("k").agg(F.min("cluster").alias("cluster"))
    return df.select(F.col(key)).join(best.withColumnRenamed("k", key), key, "left")


# ------------------------------------------------------------------- risk score


def risk_score(df: DataFrame, weights: dict[str, float], rates: dict[str, float], bias: float, profit: Column, least_profit: float, quantile: float = 0.9) -> DataFrame:
    """``df`` with ``linear_score``, ``is_risk_score`` (above the quantile), ``meets_profit`` and ``is_risk`` (both).

    Columns are filled by their medians, power transformed by ``rates`` (of
    ``power_rates``), put on 0 to 1, and summed by weight."""
    names = list(weights)
    inner = df.select("*", *(F.col(c).cast("double").alias(f"__w_{c}") for c in names))
    own = [f"__w_{c}" for c in names]
    scaled = range_scaled(powered(median_filled(inner, own), {f"__w_{c}": rates[c] for c in names}), own)
    linear = sum((F.col(f"__w_{c}") * w for c, w in weights.items()), F.lit(bias))
    out = scaled.withColumn("linear_score", linear).drop(*own)
    out = _beside(out, [F.percentile("linear_score", quantile).alias("__limit")])
    out = out.withColumns({"is_risk_score": F.col("linear_score") > F.col("__limit"), "meets_profit": F.coalesce(profit >= least_profit, F.lit(False))}).drop("__limit")
    return out.withColumn("is_risk", F.col("is_risk_score") & F.col("meets_profit"))


def to_normal(df: DataFrame, column: str, name: str) -> DataFrame:
    """``column`` as the normal quantile of its mean rank; the ends are at probability 1e-7."""

    @F.pandas_udf("double")
    def quantile(p: pd.Series) -> pd.Series:
        return p.clip(1e-7, 1 - 1e-7).map(NormalDist().inv_cdf, na_action="ignore")

    out = ranked(df, column, "__r").crossJoin(F.broadcast(df.agg(F.count(column).alias("__n"))))  # one row
    share = F.when(F.col("__n") > 1, (F.col("__r") - 1) / (F.col("__n") - 1)).otherwise(F.lit(0.5))
    return out.withColumn(name, quantile(F.when(F.col("__r").isNotNull(), share))).drop("__r", "__r_ties", "__n")
