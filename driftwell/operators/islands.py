"""Sessions, streaks and other runs of rows, as windows over a user's rows.

Every window here partitions by the user first, so one exchange serves them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def running(spec: WindowSpec) -> WindowSpec:
    return spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def running_group(breaks: Column, spec: WindowSpec) -> Column:
    """The number of breaks up to and with the row: rows of a run share it."""
    return F.sum(F.when(breaks, 1).otherwise(0)).over(running(spec))


def session_start(ts: Column, gap: Column, limit: int, spec: WindowSpec) -> Column:
    """The time of the last row whose gap is null or above ``limit``."""
    return F.last(F.when(gap.isNull() | (gap > limit), ts), ignorenulls=True).over(running(spec))


def gap_flags(df: DataFrame, user: str, ts: str, limit: int, name: str = "event_group", tie: str = "event_id") -> DataFrame:
    """Numbers the groups of a user's rows that gaps above ``limit`` seconds part."""
    w = Window.partitionBy(user).orderBy(ts, tie)
    gap = F.unix_timestamp(ts) - F.unix_timestamp(F.lag(ts).over(w))
    return df.withColumn("gap", gap).withColumn(name, running_group(F.coalesce(F.col("gap") > limit, F.lit(False)), w))
