"""Exploratory statistics as aggregations; only parameters reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.functions.columns import clip, ratio


def moments(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """A row for each column and group: count, mean, spread, quartiles, and bias-corrected skewness and kurtosis
    of its finite values; groups of fewer than two have none."""
    rows = df.unpivot(by, columns, "column", "value").where(F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf")))
    out = rows.groupBy(*by, "column").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("low"), F.max("value").alias("high"), F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"), F.skewness("value").alias("g1"), F.kurtosis("value").alias("g2"))
    out = out.where("n >= 2")
    n = F.col("n").cast("double")
    skew = F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6))
    return out.select(*by, "column", "n", "mean", "std", "low", "high", *(F.get("q", F.lit(i)).alias(a) for i, a in enumerate(("p25", "median", "p75"))), skew.alias("skew"), kurt.alias("kurtosis"))


def without_outliers(df: DataFrame, columns: list[str], z: float) -> DataFrame:
    """Rows whose values are all below ``z`` population deviations from the mean; 0 keeps all, a spread of 0 counts as 1."""
    if not z:
        return df
    one = df.agg(*(F.avg(c).alias(f"__m_{c}") for c in columns), *(F.stddev_pop(c).alias(f"__s_{c}") for c in columns))
    keep = F.lit(True)
    for c in columns:
        spread = F.when(F.col(f"__s_{c}") == 0, 1.0).otherwise(F.col(f"__s_{c}"))
        keep = keep & (F.abs(F.col(c) - F.col(f"__m_{c}")) / spread < z)
    return df.crossJoin(F.broadcast(one)).where(keep).select(*df.columns)  # one row


def clipped(df: DataFrame, columns: list[str], q: float) -> DataFrame:
    """Values above the ``q`` quantile of the positives, or below the 1 - q quantile of the negatives, moved to it."""
    bounds = []
    for c in columns:
        bounds += [F.percentile(F.when(F.col(c) > 0, F.col(c)), q).alias(f"__h_{c}"), F.percentile(F.when(F.col(c) < 0, F.col(c)), 1 - q).alias(f"__l_{c}")]
    out = df.crossJoin(F.broadcast(df.agg(*bounds)))  # one row
    return out.select(*(clip(F.col(c), F.col(f"__l_{c}"), F.col(f"__h_{c}")).alias(c) if c in columns else F.col(c) for c in df.columns))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, r) of each pair of columns, in one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    one = df.agg(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(a, b).alias("r")) for a, b in pairs)).alias("all"))
    return one.select(F.inline("all"))


def anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """One-way F of ``value`` over ``group``, from grouped sums."""
    g = df.groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("m"), F.coalesce(F.var_pop(value), F.lit(0.0)).alias("v"))
    one = g.agg(F.count("*").alias("k"), F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean"), F.sum(F.col("n") * F.col("m") ** 2).alias("sq"), F.sum(F.col("n") * F.col("v")).alias("within"))
    between = F.col("sq") - F.col("n") * F.col("mean") ** 2
    f = ratio(between / (F.col("k") - 1), F.col("within") / (F.col("n") - F.col("k")))
    return one.select("k", "n", f.alias("f"))


def agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index and normalised mutual information of two labellings."""
    cells = df.groupBy(a, b).agg(F.count("*").cast("double").alias("n"))
    rows, cols = (cells.groupBy(x).agg(F.sum("n").alias(f"n_{x}")) for x in (a, b))
    two = lambda c: F.sum(c * (c - 1) / 2)
    total = cells.agg(F.sum("n").alias("t"), two(F.col("n")).alias("ij"))
    ra, rb = (x.agg(two(F.col(f"n_{n}")).alias(f"s_{n}"), F.sum(F.col(f"n_{n}") * F.log(f"n_{n}")).alias(f"l_{n}")) for x, n in ((rows, a), (cols, b)))
    mi = cells.agg(F.sum(F.col("n") * F.log("n")).alias("l"))
    one = total.crossJoin(ra).crossJoin(rb).crossJoin(mi)  # one row each
    t = F.col("t")
    expected = F.col(f"s_{a}") * F.col(f"s_{b}") / (t * (t - 1) / 2)
    ari = (F.col("ij") - expected) / F.nullif((F.col(f"s_{a}") + F.col(f"s_{b}")) / 2 - expected, F.lit(0.0))
    entropy = lambda n: F.log(t) - F.col(f"l_{n}") / t
    mutual = (F.col("l") - F.col(f"l_{a}") - F.col(f"l_{b}")) / t + F.log(t)
    return one.select(ari.alias("ari"), (mutual / F.nullif((entropy(a) + entropy(b)) / 2, F.lit(0.0))).alias("nmi"))
