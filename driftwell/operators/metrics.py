"""The cohort metric catalogue: any set of metrics is one aggregation of user-day rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.functions.columns import ratio

ACTIVE_BETS = 40
HORIZONS = {"day": (1, 2, 3), "week": (7, 14, 21), "month": (31, 62, 93)}


def _sum(name: str) -> Column:
    return F.sum(F.col(name))


def _users() -> Column:
    return F.count_distinct("user_id")


def _rows(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def catalogue(active: int = ACTIVE_BETS) -> dict[str, tuple[tuple[str, ...], Column]]:
    """Name to (columns it reads, aggregate).  The public spelling of the last ratio is kept."""
    out: dict[str, tuple[tuple[str, ...], Column]] = {
        "num_active_users": (("user_id", "user_num_bets"), F.count_distinct(F.when(F.col("user_num_bets") >= active, F.col("user_id")))),
        "num_new_users": (("user_id", "user_group"), F.count_distinct(F.when(F.col("user_group") == "new", F.col("user_id")))),
        "day0_num_users": (("user_id",), _users()),
    }
    sums = ["num_bets", "num_bets_bg", "num_bets_fg", "num_bets_with_payout", "num_bets_bg_with_payout", "num_bets_fg_with_payout"]
    out |= {f"total_{x}": ((f"user_{x}",), _sum(f"user_{x}")) for x in sums}
    out |= {f"total_{x}": ((f"user_total_{x}",), _sum(f"user_total_{x}")) for x in ("bet", "bet_bg", "bet_fg", "payout", "payout_bg", "payout_fg")}
    bet, payout, bets = _sum("user_total_bet"), _sum("user_total_payout"), _sum("user_num_bets")
    profit = payout - bet
    out |= {
        "total_num_bets_per_user": (("user_num_bets", "user_id"), ratio(bets, _users())),
        "total_bet_per_user": (("user_total_bet", "user_id"), ratio(bet, _users())),
        "total_profit": (("user_total_payout", "user_total_bet"), profit),
        "total_profit_per_user": (("user_total_payout", "user_total_bet", "user_id"), ratio(profit, _users())),
        "rtp": (("user_total_payout", "user_total_bet"), ratio(payout, bet)),
        "rtp_bg": (("user_total_payout_bg", "user_total_bet"), ratio(_sum("user_total_payout_bg"), bet)),
        "rtp_fg": (("user_total_payout_fg", "user_total_bet_fg"), ratio(_sum("user_total_payout_fg"), _sum("user_total_bet_fg"))),
        "fg_ratio": (("user_num_bets_fg", "user_num_bets"), ratio(_sum("user_num_bets_fg"), bets)),
        "hit_rate": (("user_num_bets_with_payout", "user_num_bets"), ratio(_sum("user_num_bets_with_payout"), bets)),
        "hit_rate_bg": (("user_num_bets_bg_with_payout", "user_num_bets_bg"), ratio(_sum("user_num_bets_bg_with_payout"), _sum("user_num_bets_bg"))),
        "hit_rate_fg": (("user_num_bets_fg_with_payout", "user_num_bets_fg"), ratio(_sum("user_num_bets_fg_with_payout"), _sum("user_num_bets_fg"))),
        "active_user_no_fg_ratio": (("user_num_bets_fg", "user_id"), ratio(_rows(F.col("user_num_bets_fg") == 0), _users())),
        "num_active_user_0_rtp": (("user_total_payout",), _rows(F.col("user_total_payout") == 0)),
        "active_user_0_rtp_ratio": (("user_total_payout", "user_id"), ratio(_rows(F.col("user_total_payout") == 0), _users())),
    }
    for tenth in range(1, 6):
        low = (F.col("user_total_bet") > 0) & (F.col("user_rtp") < tenth / 10)
        out[f"active_user_rtp_less_0_{tenth}_ratio"] = (("user_total_bet", "user_rtp", "user_id"), ratio(_rows(low), _users()))
    median = F.median(F.when(F.col("user_total_bet") > 0, ratio("user_total_payout", "user_total_bet")))
    out["user_rtp_median"] = (("user_total_payout", "user_total_bet"), median)
    out["user_rtp_ultilization_ratio"] = (("user_total_payout", "user_total_bet"), ratio(median, ratio(payout, bet)))
    return out


def metrics(rows: DataFrame, keys: list[str], names: list[str] | None = None, active: int = ACTIVE_BETS) -> DataFrame:
    """The named metrics by ``keys``; all that the columns of ``rows`` allow by default."""
    known = catalogue(active)
    names = [n for n, (need, _) in known.items() if set(need) <= set(rows.columns)] if names is None else names
    return rows.groupBy(*keys).agg(*(known[n][1].alias(n) for n in names))


def retention(rows: DataFrame, keys: list[str], date: str, grain: str = "day") -> DataFrame:
    """Users of each date and key, and how many of them the same key has at the three horizons.

    Presence is read from all of ``rows``; the follow-up matches every other key
    too.  One equi-join a horizon, on shifted dates.
    """
    present = rows.select(*keys, date, "user_id").distinct()
    out = present
    for i, days in enumerate(HORIZONS[grain], 1):
        later = present.select(*keys, F.date_sub(date, days).alias(date), "user_id", F.lit(1).alias(f"back{i}"))
        out = out.join(later, [*keys, date, "user_id"], "left")
    counts = [F.count("*").alias("day0_num_users"), *(F.count(f"back{i}").alias(f"day{i}_num_users") for i in (1, 2, 3))]
    out = out.groupBy(*keys, date).agg(*counts)
    return out.select("*", *(ratio(f"day{i}_num_users", "day0_num_users").alias(f"retention_rate_day{i}") for i in (1, 3)))


def quality(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls (and NaNs of doubles) of each column, in one row."""
    kinds = dict(rows.dtypes)
    bad = lambda c: F.col(c).isNull() | F.isnan(c) if kinds[c] in ("double", "float") else F.col(c).isNull()
    return rows.agg(*(F.sum(F.when(bad(c), 1).otherwise(0)).alias(c) for c in columns))
