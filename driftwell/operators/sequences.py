"""Windows over users' rows beyond sessions and streaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.functions.columns import day_part, ratio, seconds
from driftwell.operators.islands import running, running_group


def user_counts(bets: DataFrame) -> DataFrame:
    """Bets with the user's number of bets, and whether the table changed since the bet before."""
    own = Window.partitionBy("user_id")
    before = F.lag("table_id").over(own.orderBy("created_at", "spin_id"))
    changed = F.when(before.isNull(), 0).when(before != F.col("table_id"), 1).otherwise(0)
    return bets.select("*", F.count("*").over(own).alias("user_bet_count"), changed.alias("mathtable_change"))


def share_of_group(df: DataFrame, keys: list[str], within: list[str], name: str = "share") -> DataFrame:
    """Rows of each key and their share of the rows of ``within``: a window over an aggregate."""
    n = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return n.withColumn(name, ratio(F.col("n"), F.sum("n").over(Window.partitionBy(*within))))


def last_active_day(bullets: DataFrame) -> DataFrame:
    """Each user's days, their bullets, and the day before of the same user: a lag over grouped rows."""
    days = bullets.groupBy("user_id", F.to_date("event_timestamp").alias("day")).agg(F.count("*").alias("bullets"))
    return days.withColumn("day_last_bet", F.lag("day").over(Window.partitionBy("user_id").orderBy("day")))


def free_rounds_per_base(bets: DataFrame) -> DataFrame:
    """BASE bets and the number of FREE rounds that follow each before the next one."""
    w = Window.partitionBy("user_id").orderBy("spin_id", "created_at")
    rows = bets.withColumn("base_group", running_group(F.col("bet_type") == "BASE", w))
    free = F.count(F.when(F.col("bet_type") == "FREE", 1)).over(Window.partitionBy("user_id", "base_group"))
    return rows.withColumn("free_rounds", free).where("bet_type = 'BASE'")


def block_totals(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    return df.withColumn(name, F.sum(value).over(Window.partitionBy(*keys)))


def group_extremes(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows with their group's largest value, sum and size."""
    w = Window.partitionBy(*keys)
    return df.select("*", F.max(value).over(w).alias(f"{value}_max"), F.sum(value).over(w).alias(f"{value}_sum"), F.count("*").over(w).alias("group_size"))


def previous(column: str, user: str, *order: str, default: float | None = None) -> Column:
    before = F.lag(column).over(Window.partitionBy(user).orderBy(*order))
    return before if default is None else F.coalesce(before, F.lit(default))


def delta(column: str, user: str, *order: str) -> Column:
    return F.col(column) - previous(column, user, *order)


def near_events(df: DataFrame, user: str, ts: str, limit: int, side: str = "both", far: bool = False, tie: str = "event_id") -> Column:
    """Is the gap to the event before, after, or either of them within ``limit`` seconds (``far``: above it); no such event is false."""
    w = Window.partitionBy(user).orderBy(ts, tie)
    gaps = {"before": seconds(F.lag(ts).over(w), ts), "after": seconds(ts, F.lead(ts).over(w))}
    test = [F.coalesce(g > limit if far else g <= limit, F.lit(False)) for k, g in gaps.items() if side in (k, "both")]
    return test[0] if len(test) == 1 else test[0] | test[1]


def fold_free_spins(bets: DataFrame) -> DataFrame:
    """BASE spins with the payout of the FREE run after them added; FREE spins go, also those before any BASE spin."""
    w = Window.partitionBy("user_id").orderBy("spin_id", "created_at")
    rows = bets.withColumn("base_group", running_group(F.col("bet_type") == "BASE", w)).where("base_group > 0")
    own = lambda c: F.max(F.when(F.col("bet_type") == "BASE", F.col(c)))
    return rows.groupBy("user_id", "base_group").agg(own("spin_id").alias("spin_id"), own("created_at").alias("created_at"), own("bet_amount").alias("bet_amount"), F.sum("payout").alias("payout"), F.count(F.when(F.col("bet_type") == "FREE", 1)).alias("free_spins"))


def context_columns(bets: DataFrame) -> DataFrame:
    """Bets with the last bet and payout of the user, and the running profit before the bet (0 at first)."""
    w = Window.partitionBy("user_id").orderBy("spin_id")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return bets.select("*", zero(F.lag("bet_amount").over(w)).alias("last_bet"), zero(F.lag("payout").over(w)).alias("last_payout"), zero(F.sum(F.col("payout") - F.col("bet_amount")).over(before)).alias("profit_sofar"))


# ------------------------------------------------------------- the legacy job


def legacy_enriched(bets: DataFrame, streak_gap: int = 200, split_gap: int = 604_800, size: int = 40) -> DataFrame:
    """A user's bets with gaps, balance moves, streaks from 0 and groups of ``size`` that long gaps part.

    The first bet's gaps and changes are from 0, and a streak counts the bets
    before in it; both unlike the feature pipeline."""
    w = Window.partitionBy("user_id").orderBy("created_at", "spin_id")
    profit = F.col("payout") - F.col("bet_amount")
    rows = bets.select(
        "*",
        profit.alias("profit"),
        F.coalesce(seconds(F.lag("created_at").over(w), "created_at"), F.lit(0.0)).alias("delta_t"),
        (F.col("bet_amount") - F.coalesce(F.lag("bet_amount").over(w), F.lit(0.0))).alias("delta_bet"),
        (profit - F.coalesce(F.lag(profit).over(w), F.lit(0.0))).alias("delta_profit"),
        F.coalesce(F.col("balance_after_bet") - F.lag("balance_after_payout").over(w), F.lit(0.0)).alias("balance_change"),
        F.signum(profit).alias("sign"),
        day_part(F.col("created_at")).alias("part"),
    )
    rows = rows.withColumn("far", F.col("delta_t") > streak_gap).withColumn("turn", F.lag("sign").over(w).isNull() | (F.lag("sign").over(w) != F.col("sign")))
    rows = rows.withColumn("run", running_group(F.col("far"), w)).withColumn("sign_run", running_group(F.col("far") | F.col("turn"), w)).withColumn("group_index", running_group(F.col("delta_t") > split_gap, w))
    nth = lambda by: F.row_number().over(Window.partitionBy("user_id", by).orderBy("created_at", "spin_id")) - 1
    rows = rows.withColumn("streak", nth("run")).withColumn("sign_streak", nth("sign_run"))
    return rows.select(
        *bets.columns,
        "profit", "delta_t", "delta_bet", "delta_profit", "part", "streak", "group_index",
        F.when(F.col("sign") > 0, F.col("sign_streak")).otherwise(0).alias("win_streak"),
        F.when(F.col("sign") < 0, F.col("sign_streak")).otherwise(0).alias("lose_streak"),
        F.greatest(F.col("balance_change"), F.lit(0.0)).alias("deposit"),
        F.greatest(-F.col("balance_change"), F.lit(0.0)).alias("withdrawal"),
        F.floor(nth("group_index") / size).cast("long").alias("sub_index"),
    )


#: Columns of the legacy job's groups and the names of their statistics.
LEGACY = {"bet_amount": "bet", "balance_after_bet": "basepoint", "payout": "payout", "profit": "profit", "delta_t": "delta_t", "delta_bet": "delta_bet", "delta_profit": "delta_profit", "streak": "streak", "win_streak": "win_streak", "lose_streak": "lose_streak", "deposit": "deposit", "withdrawal": "withdrawal"}


def legacy_grouped(rows: DataFrame) -> DataFrame:
    """Some seventy statistics of each group of ``legacy_enriched`` in one aggregation, and its most used table (ties: the smallest)."""
    aggs = [F.count("*").alias("group_num"), F.avg(F.when(F.col("bet_amount") != 0, F.col("payout") / F.col("bet_amount")).otherwise(0.0)).alias("rtp_mean")]
    for c, name in LEGACY.items():
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{name}_mean"), F.coalesce(F.stddev_samp(x), F.lit(0.0)).alias(f"{name}_std"), F.min(x).alias(f"{name}_min"), F.max(x).alias(f"{name}_max"), F.sum(x).alias(f"{name}_sum")]
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    span = seconds(F.min("created_at"), F.max("created_at"))
    aggs += [
        count(F.col("bet_type") == "FREE").alias("free_count"),
        (count(F.col("payout") > 0) / F.count("*")).alias("payout_rate"),
        (count(F.col("profit") > 0) / F.count("*")).alias("profit_rate"),
        F.min("created_at").alias("start_time"),
        F.max("created_at").alias("end_time"),
        *(count(F.col("part") == p).alias(f"{p}_count") for p in ("morning", "afternoon", "night", "midnight")),
        count(F.dayofweek("created_at").isin(1, 7)).alias("weekend_count"),
        span.alias("duration_seconds"),
        (span / F.count("*")).alias("avg_time_per_bet"),
        F.mode("table_id", deterministic=True).alias("table_mode"),
    ]
    return rows.groupBy("user_id", "group_index", "sub_index").agg(*aggs)
