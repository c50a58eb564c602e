"""Column helpers: guarded ratios, bands, clips, times and cells."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(top, bottom) -> Column:
    """top / bottom, null where bottom is 0."""
    top, bottom = (F.col(x) if isinstance(x, str) else x for x in (top, bottom))
    return top / F.nullif(bottom.cast("double"), F.lit(0.0))


def exact_mean(top: str, bottom: str) -> Column:
    """The mean of top - bottom over a group, summed in decimals so that neither order nor rounding counts;
    a group with a value that isn't one of at most 10 places is averaged in doubles."""
    a, b = (F.col(x).try_cast("decimal(28,10)") for x in (top, bottom))
    apart = F.col(top) - F.col(bottom)
    whole = F.bool_and(F.when(apart.isNotNull(), F.coalesce((a.cast("double") == F.col(top)) & (b.cast("double") == F.col(bottom)), F.lit(False))))
    summed = F.try_sum(F.when(apart.isNotNull(), a - b)).cast("double") / F.count(apart)
    return F.when(whole, F.coalesce(summed, F.avg(apart))).otherwise(F.avg(apart))


def exact_deviation(top: str, bottom: str) -> Column:
    """The sample deviation of top - bottom over a group, of sums of decimals so that order doesn't count;
    of doubles where the mean isn't small beside it or a value isn't one of at most 6 places and 11 digits before them."""
    a, b = (F.col(x).try_cast("decimal(17,6)") for x in (top, bottom))
    apart = F.col(top) - F.col(bottom)
    whole = F.bool_and(F.when(apart.isNotNull(), F.coalesce((a.cast("double") == F.col(top)) & (b.cast("double") == F.col(bottom)), F.lit(False))))
    squares = F.try_sum((a - b) * (a - b)).cast("double")
    around = squares - F.pow(F.try_sum(a - b).cast("double"), F.lit(2)) / F.count(apart)
    exact = F.sqrt(around / F.nullif(F.count(apart) - 1, F.lit(0)))
    return F.when(whole & (2 * around >= squares), exact).otherwise(F.stddev_samp(apart))


def band(value: Column, edges: list[tuple[float, str]], other: str) -> Column:
    """The first label whose edge is at or above ``value``; null and larger ones are ``other``."""
    out = F.lit(other)
    for edge, label in reversed(edges):
        out = F.when(value <= edge, label).otherwise(out)
    return out


def gap_seconds(before: Column, after: Column) -> Column:
    """Whole seconds crossed between two timestamps."""
    return F.unix_timestamp(after) - F.unix_timestamp(before)


def micros(ts: Column | str) -> Column:
    """Whole microseconds since 1970, of either kind of timestamp."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def seconds(before: Column | str, after: Column | str) -> Column:
    """Seconds between two timestamps with their fraction."""
    return (micros(after) - micros(before)) / F.lit(1e6)


def clip(value: Column, low: Column, high: Column) -> Column:
    """``value`` within bounds; a null bound doesn't bind, a null value stays null."""
    return F.when(value.isNotNull(), F.greatest(low, F.least(value, high)))


def symlog(value: Column) -> Column:
    return F.signum(value) * F.log10(F.abs(value) + 1)


def any_of(predicates: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates, F.lit(False))


def row_filters(df: DataFrame, filters: dict) -> DataFrame:
    """Equality or membership; None, '' and [] switch a filter off, and so does a column that isn't there."""
    for name, value in filters.items():
        if name in df.columns and value not in (None, "", []):
            df = df.where(F.col(name).isin(value) if isinstance(value, list) else F.col(name) == value)
    return df


def day_part(ts: Column) -> Column:
    hour = F.hour(ts)
    return F.when(hour < 6, "midnight").when(hour < 12, "morning").when(hour < 18, "afternoon").otherwise("night")


def period_start(ts: Column, grain: str) -> Column:
    """The day, Monday or first of the month that holds ``ts``."""
    return F.to_date(F.date_trunc(grain, ts))


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """``df`` with doubles rounded, as queries return them."""
    return df.select(*((F.round(c, places) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))
