"""As-of, band and upsert joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, values: list[str]) -> DataFrame:
    """``left`` with the ``values`` of the last row of ``right`` at or before its time, by ``key``.

    Both sides are one sorted pass: no range join.  A struct carries the values,
    so a null value of the last row stays null."""
    names = left.columns
    mark = F.struct(right_ts, *values)
    rows = left.select(F.col(key).alias("__key"), F.col(left_ts).alias("__ts"), F.lit(1).alias("__side"), F.struct(*names).alias("__left"))
    marks = right.select(F.col(key).alias("__key"), F.col(right_ts).alias("__ts"), F.lit(0).alias("__side"), mark.alias("__mark"))
    order = Window.partitionBy("__key").orderBy("__ts", "__side").rowsBetween(Window.unboundedPreceding, 0)
    both = rows.unionByName(marks, allowMissingColumns=True).withColumn("__last", F.last("__mark", ignorenulls=True).over(order))
    return both.where("__side = 1").select("__left.*", *(F.col(f"__last.{c}").alias(c) for c in (right_ts, *values)))


def band(left: DataFrame, right: DataFrame, key: str, start: str, ts: str, seconds: int) -> DataFrame:
    """Rows of ``right`` within ``seconds`` from a ``start`` of the same key; an equi-join with a residual range."""
    until = F.col(start) + F.make_dt_interval(secs=F.lit(seconds))
    return left.join(right, key).where((F.col(ts) >= F.col(start)) & (F.col(ts) < until))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """A full outer merge where values of ``new`` win if they aren't null."""
    values = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in keys]
    a = old.select(*keys, *(F.col(c).alias(f"__old_{c}") for c in old.columns if c not in keys))
    b = new.select(*keys, *(F.col(c).alias(f"__new_{c}") for c in new.columns if c not in keys))
    side = lambda p, df, c: [F.col(f"{p}{c}")] if c in df.columns else []
    return a.join(b, keys, "full_outer").select(*keys, *(F.coalesce(*side("__new_", new, c), *side("__old_", old, c)).alias(c) for c in values))


def last_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
