"""The per-bet, session and bin feature pipeline as a chain of DataFrame steps."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwell.functions.columns import gap_seconds, ratio
from driftwell.operators.islands import running, running_group, session_start

METRICS = ("delta_t_seconds", "delta_t_seconds_nogap", "bet_amount", "delta_bet_amount", "payout", "profit", "delta_payout", "balance_after_bet", "streak", "win_streak", "lose_streak")
BASE_KEY = ("user_id", "ai_group", "session_start_date", "session_group", "agg_group")


@dataclass(frozen=True)
class FeatureConfig:
    """What decides the pipeline's rows; thresholds in seconds."""

    session_break: int = 43_200
    streak_break: int = 21_600
    nogap: int = 21_600
    bin_sizes: tuple[int, ...] = (3, 5)
    partition_cols: tuple[str, ...] = ()
    full_bins: bool = True
    dead_zone: float = 0.1

    def __post_init__(self):
        if not self.bin_sizes or min(self.bin_sizes) < 1:
            raise ValueError("bin sizes must be positive")
        if min(self.session_break, self.streak_break, self.nogap) <= 0:
            raise ValueError("thresholds must be positive")

    @property
    def key(self) -> list[str]:
        return [*BASE_KEY[:2], *self.partition_cols, *BASE_KEY[2:]]

    @property
    def lookback_days(self) -> int:
        """Days to read before a start date so that its sessions are whole."""
        return ceil(self.session_break / 86_400) + 1


def _order(*more: str):
    return Window.partitionBy("user_id").orderBy("spin_id", *more)


def user_bets(bets: DataFrame, cfg: FeatureConfig) -> DataFrame:
    return bets.withColumn("bet_amount", F.when(F.col("bet_type") == "BASE", F.col("bet_amount"))).withColumn("prev_bet_time", F.lag("created_at").over(_order("created_at")))


def free_game_group(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Each BASE row begins a group that takes in the FREE rows after it."""
    return df.withColumn("fg_group", running_group(F.col("bet_type") == "BASE", _order("created_at")))


def agg_free_game(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    return df.groupBy("user_id", "ai_group", *cfg.partition_cols, "fg_group").agg(
        F.min("spin_id").alias("spin_id"),
        F.min("created_at").alias("min_created_at"),
        F.max("created_at").alias("max_created_at"),
        F.count(F.when(F.col("bet_type") == "FREE", 1)).alias("fg_rounds"),
        F.min("prev_bet_time").alias("prev_bet_time"),
        F.sum("bet_amount").alias("bet_amount"),
        F.sum("payout").alias("payout"),
        F.min("balance_after_bet").alias("balance_after_bet"),
        F.max("balance_after_payout").alias("balance_after_payout"),
    )


def delta_stats(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    w = _order("min_created_at")
    bet, payout = F.col("bet_amount"), F.col("payout")
    lag_bet, lag_payout = F.lag(bet).over(w), F.lag(payout).over(w)
    flag = lambda c: F.when(c, 1).otherwise(0)
    return df.select(
        "*",
        gap_seconds(F.col("prev_bet_time"), F.col("min_created_at")).alias("delta_t_seconds"),
        (bet - lag_bet).alias("delta_bet_amount"),
        (payout - lag_payout).alias("delta_payout"),
        (F.col("balance_after_bet") + bet - F.lag("balance_after_payout").over(w)).alias("balance_transaction"),
        flag(payout > bet).alias("is_win"),
        flag(payout < bet).alias("is_lose"),
        flag(lag_payout > lag_bet).alias("prev_win"),
        flag(lag_payout < lag_bet).alias("prev_lose"),
    )


def user_group(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    w = _order("min_created_at")
    near = F.coalesce(F.col("delta_t_seconds") <= cfg.streak_break, F.lit(False))
    both = lambda kind: near & (F.col(f"prev_{kind}") == 1) & (F.col(f"is_{kind}") == 1)
    return df.select(
        "*",
        session_start(F.col("min_created_at"), F.col("delta_t_seconds"), cfg.session_break, w).alias("session_start_ts"),
        running_group(~near, w).alias("streak_group"),
        running_group(~both("win"), w).alias("win_streak_group"),
        running_group(~both("lose"), w).alias("lose_streak_group"),
    )


def raw_stats(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    w = _order("min_created_at")
    df = df.withColumn("session_start_date", F.to_date("session_start_ts"))
    nth = lambda *by: F.row_number().over(Window.partitionBy("user_id", *by).orderBy("spin_id", "min_created_at"))
    moved = F.col("balance_transaction")
    return df.select(
        "*",
        (F.dense_rank().over(Window.partitionBy("user_id", "session_start_date").orderBy("session_start_ts")) - 1).alias("session_group"),
        F.to_date("min_created_at").alias("activity_date"),
        F.when(F.col("delta_t_seconds") <= cfg.nogap, F.col("delta_t_seconds")).alias("delta_t_seconds_nogap"),
        (F.col("payout") - F.col("bet_amount")).alias("profit"),
        F.when(moved > cfg.dead_zone, moved).alias("deposit"),
        F.when(moved < -cfg.dead_zone, -moved).alias("withdraw"),
        nth("streak_group").alias("streak"),
        F.when(F.col("payout") > F.col("bet_amount"), nth("win_streak_group")).alias("win_streak"),
        F.when(F.col("payout") < F.col("bet_amount"), nth("lose_streak_group")).alias("lose_streak"),
        nth("session_start_ts").alias("session_bet_index"),
    )


def enriched(bets: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """A row for each bet with its free games; the bin sizes don't matter yet."""
    for step in (user_bets, free_game_group, agg_free_game, delta_stats, user_group, raw_stats):
        bets = bets.transform(step, cfg)
    return bets


def binned(df: DataFrame, size: int) -> DataFrame:
    return df.withColumn("agg_group", F.floor((F.col("session_bet_index") - 1) / size).cast("long"))


def grouped(rows: DataFrame, cfg: FeatureConfig, size: int) -> DataFrame:
    """A row for each bin: all base statistics, percentiles and ratios in one aggregation."""
    x = {m: F.col(m).cast("double") for m in METRICS} | {"rtp": ratio("payout", "bet_amount")}
    sums = lambda c, cond: F.sum(F.when(cond, c).otherwise(0.0))
    profit, d_bet = x["profit"], x["delta_bet_amount"]
    aggs = [F.min("activity_date").alias("activity_date"), F.min("min_created_at").alias("min_created_at"), F.max("min_created_at").alias("max_created_at"), F.count("user_id").alias("bet_rounds"), F.sum("fg_rounds").alias("fg_rounds")]
    for m, c in x.items():
        aggs += [F.avg(c).alias(f"{m}_avg"), F.stddev_samp(c).alias(f"{m}_std"), F.min(c).alias(f"{m}_min"), F.max(c).alias(f"{m}_max"), F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"{m}_p")]
    aggs += [
        sums(d_bet, d_bet > 0).alias("accum_pos_delta_bet_amount"),
        sums(d_bet, d_bet < 0).alias("accum_neg_delta_bet_amount"),
        (F.sum(F.when(F.col("payout") > F.col("bet_amount"), 1)) / F.count("user_id")).alias("payout_rate"),
        (F.sum(F.when(profit > 0, 1).otherwise(0)) / F.count("user_id")).alias("profit_rate"),
        sums(profit, profit > 0).alias("accum_pos_profit"),
        sums(profit, profit < 0).alias("accum_neg_profit"),
        F.count("deposit").alias("num_deposit"),
        F.sum("deposit").alias("accum_deposit"),
        F.count("withdraw").alias("num_withdraw"),
        F.sum("withdraw").alias("accum_withdraw"),
    ]
    out = rows.transform(binned, size).dropna(subset=list(cfg.key)).groupBy(*cfg.key).agg(*aggs)
    if cfg.full_bins:
        out = out.where(F.col("bet_rounds") == size)
    cols = [*cfg.key, "activity_date", "min_created_at", "max_created_at", "bet_rounds", "fg_rounds"]
    new = {}
    for m in x:
        new |= {f"{m}_{n}": F.get(f"{m}_p", F.lit(i)) for i, n in enumerate(("p25", "median", "p75"))}
    bet = F.col("bet_amount_avg")
    for m, over in (("bet_amount", bet), ("delta_bet_amount", bet), ("payout", bet), ("delta_payout", bet), ("balance_after_bet", F.col("balance_after_bet_avg"))):
        fill = (lambda c: F.coalesce(c, F.lit(0.0))) if m.startswith("delta") else (lambda c: c)
        new[f"{m}_cv"] = fill(ratio(F.col(f"{m}_std"), F.abs(over)))
        new[f"{m}_drawdown"] = fill(ratio(F.col(f"{m}_min"), over))
        new[f"{m}_spike"] = fill(ratio(F.col(f"{m}_max"), over))
    new["profit_cv"] = ratio(F.col("profit_std"), F.abs(F.col("profit_avg")))
    for n in ("min_profit", "max_profit"):
        new[f"{n}_ratio"] = ratio(F.col(f"profit_{n[:3]}"), bet)
    for n in ("accum_pos_delta_bet_amount", "accum_neg_delta_bet_amount", "accum_pos_profit", "accum_neg_profit", "accum_deposit", "accum_withdraw"):
        new[f"{n}_ratio"] = ratio(n, bet)
    zero = {f"{m}_{n}" for m in ("streak", "win_streak", "lose_streak") for n in ("avg", "std", "min", "max", "p25", "median", "p75")}
    cols += [c for c in out.columns if c not in cols and not c.endswith("_p")]
    out = out.withColumns(new).drop(*(f"{m}_p" for m in x))
    cols += list(new)
    return out.select(*(F.coalesce(c, F.lit(0.0)).alias(c) if c in zero else F.col(c) for c in cols))
