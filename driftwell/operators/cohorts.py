"""Returning users by what they did, labelled bins and rounds of payouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.functions.columns import band, ratio, seconds
from driftwell.operators.islands import running, running_group
from driftwell.operators.joins import last_by
from driftwell.operators.userstats import FISH_BANDS

#: Bands of a session's seconds and of its kills.
TIME_BANDS = [(60, "0-1_min"), (180, "1-3_min"), (300, "3-5_min"), (600, "5-10_min")]
KILL_BANDS = [(0, "kill_fish_0"), (1, "kill_fish_1"), (3, "kill_fish_2-3"), (5, "kill_fish_4-5"), (10, "kill_fish_6-10")]
#: What the levels of a round multiply by; further ones as the last.
MULTIPLIERS = (2, 4, 6, 10)


def returns(bullets: DataFrame) -> DataFrame:
    """Of each user and day: whether the user is back 24 to 48 and 72 to 96 hours after the day's first shot, in the next
    calendar week, and in the next month.

    Only days that can hold an hour of a window meet: equi-joins on shifted days."""
    day = F.to_date("event_timestamp")
    days = bullets.groupBy("user_id", day.alias("day")).agg(F.min("event_timestamp").alias("first"), F.max("event_timestamp").alias("last"))
    again = days.select("user_id", F.explode(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda n: F.date_sub("day", n))).alias("day"), F.col("first").alias("f2"), F.col("last").alias("l2"))
    hours = lambda n: F.col("first") + F.make_dt_interval(hours=F.lit(n))
    inside = lambda a, b: F.max(F.when((F.col("l2") >= hours(a)) & (F.col("f2") < hours(b)), 1).otherwise(0))
    out = days.join(again, ["user_id", "day"], "left").groupBy("user_id", "day").agg(inside(24, 48).alias("day1_return"), inside(72, 96).alias("day3_return"))
    for grain, shift in (("week", lambda c: F.date_sub(c, 7)), ("month", lambda c: F.add_months(c, -1))):
        period = F.to_date(F.date_trunc(grain, "day"))
        later = days.select("user_id", shift(period).alias("period")).distinct().withColumn("back", F.lit(1))
        out = out.withColumn("period", period).join(later, ["user_id", "period"], "left").withColumn(f"{grain}1_return", F.coalesce("back", F.lit(0))).drop("period", "back")
    return out


def returns_by_play(bullets: DataFrame, gap: int) -> DataFrame:
    """Users and the shares that return, by fish band, time into the session and kills of the band so far in it (gaps up to ``gap`` continue one)."""
    w = Window.partitionBy("user_id").orderBy("event_timestamp", "bullet_id")
    far = ~F.coalesce(seconds(F.lag("event_timestamp").over(w), "event_timestamp") <= gap, F.lit(False))
    rows = bullets.select("*", band(F.col("fish_value"), FISH_BANDS, "ultra").alias("fish_type"), running_group(far, w).alias("session"))
    own = Window.partitionBy("user_id", "session")
    kills = F.sum("killed").over(running(Window.partitionBy("user_id", "session", "fish_type").orderBy("event_timestamp", "bullet_id")))
    rows = rows.select("user_id", F.to_date("event_timestamp").alias("day"), "fish_type", band(seconds(F.min("event_timestamp").over(own), "event_timestamp"), TIME_BANDS, ">10_min").alias("time_window"), band(kills, KILL_BANDS, "kill_fish_>10").alias("kill_fish"))
    rows = rows.distinct().join(returns(bullets), ["user_id", "day"])
    share = lambda c: ratio(F.count_distinct(F.when(F.col(f"{c}_return") == 1, F.col("user_id"))), F.count_distinct("user_id")).alias(f"{c}_retention_ratio")
    return rows.groupBy("fish_type", "time_window", "kill_fish").agg(F.count_distinct("user_id").alias("num_users"), *(share(c) for c in ("day1", "day3", "week1", "month1")))


def forward_retention(days: DataFrame, group: str, offsets: tuple[int, ...] = (1, 3, 7)) -> DataFrame:
    """Users of each day and group, and how many of them are there (in any group) exactly so many days later."""
    seen = days.select("user_id", "activity_date").distinct()
    out = days.select("user_id", "activity_date", group).distinct()
    for n in offsets:
        out = out.join(seen.select("user_id", F.date_sub("activity_date", n).alias("activity_date"), F.lit(1).alias(f"back{n}")), ["user_id", "activity_date"], "left")
    return out.groupBy(group, "activity_date").agg(F.count("*").alias("num_users_day0"), *(F.count(f"back{n}").alias(f"num_users_day{n}") for n in offsets))


def age_group(days: Column) -> Column:
    """The second naming of users by days since their first bet."""
    return F.when(days < 1, "day0_user").when(days < 7, "day1-6_user").otherwise("day7+_user")


def with_arms(stats: DataFrame, mapping: DataFrame, order: list) -> DataFrame:
    """Every row of ``stats`` with the arm of its user: of a user's several mappings the first in ``order``; the arm is four letters of the id."""
    clean = mapping.select(F.regexp_replace("ab_group_id", '^"+|"+$', "").alias("ab_group_id"), F.col("user_id").try_cast("long").alias("user_id"), *(c for c in mapping.columns if c not in ("ab_group_id", "user_id")))
    one = last_by(clean.where(F.col("user_id").isNotNull()), ["user_id"], order).select("user_id", "ab_group_id")
    return stats.join(one, "user_id", "left").withColumn("ab_arm", F.lower(F.substring("ab_group_id", 1, 4)))


def bin_transitions(features: DataFrame, labels: DataFrame, session: list[str], place: str, label: str = "cluster_label") -> DataFrame:
    """Bins with their label, the next bin's, and both as a transition; a session's last bin goes, and a bin labelled twice counts once."""
    keys = [*session, place]
    one = labels.groupBy(*keys).agg(F.min(label).alias(label))
    joined = features.dropDuplicates(keys).join(one, keys)
    after = F.lead(label).over(Window.partitionBy(*session).orderBy(place))
    out = joined.withColumn("next_cluster", after).where("next_cluster IS NOT NULL")
    return out.withColumn("transition", F.concat(F.lit("cluster"), F.col(label).cast("string"), F.lit(":"), F.col("next_cluster").cast("string")))


def resampled_return(df: DataFrame, ts: str, group: str, payout: str, bet: str, every: str) -> DataFrame:
    """Payout over bet by group and window of time; windows without bets go."""
    out = df.groupBy(F.window(ts, every).alias("w"), group).agg(F.sum(payout).alias("p"), F.sum(bet).alias("b")).where("b <> 0")
    return out.select(F.col("w.start").alias("start"), group, (F.col("p") / F.col("b")).alias("rtp"))


def report_rows(df: DataFrame, date_col: str, start: str, values: dict[str, list]) -> DataFrame:
    """Rows from a date on whose columns are in the lists."""
    df = df.where(F.col(date_col) >= F.lit(start).cast("date"))
    for name, allowed in values.items():
        df = df.where(F.col(name).isin(*allowed))
    return df


# ----------------------------------------------------------------------- rounds


def whole_rounds(rows: DataFrame, keys: list[str], amount: str, steps: str, least: int) -> DataFrame:
    """Rows with their round's largest ``amount``, without rounds where it is 0 or that have fewer than ``least`` steps."""
    w = Window.partitionBy(*keys)
    out = rows.withColumn("base_account", F.max(amount).over(w)).withColumn("__most", F.max(steps).over(w))
    return out.where((F.col("base_account") != 0) & (F.coalesce("__most", F.lit(least)) >= least)).drop("__most")


def round_payouts(rows: DataFrame, keys: list[str], order: str, payout: str) -> DataFrame:
    """Each round's payouts in order, how many there are, and their sum."""
    held = F.transform(F.array_sort(F.collect_list(F.struct(order, payout))), lambda x: x[payout])
    out = rows.groupBy(*keys).agg(held.alias("payouts"), F.sum(payout).alias("total"))
    return out.withColumn("levels", F.size("payouts"))


def compositions(rounds: DataFrame) -> DataFrame:
    """How often each sequence of payouts comes, by its sum and length, with each level's odds: the payout over its multiplier, rounded down."""
    out = rounds.groupBy("total", "levels", "payouts").agg(F.count("*").alias("composition_count"))
    table = F.array(*(F.lit(m) for m in MULTIPLIERS))
    by = lambda i: F.get(table, F.least(i, F.lit(len(MULTIPLIERS) - 1)))
    return out.withColumn("odds", F.transform("payouts", lambda p, i: F.floor(p / by(i)).cast("long")))


def without_rare(found: DataFrame, share: float) -> DataFrame:
    """Compositions whose sum makes up ``share`` of all rounds or more, and that make up ``share`` of their sum's."""
    total = F.sum("composition_count").over(Window.partitionBy("total"))
    out = found.withColumn("payout_count", total).crossJoin(F.broadcast(found.agg(F.sum("composition_count").alias("__all"))))  # one row
    keep = (F.col("payout_count") >= F.floor(F.col("__all") * share)) & (F.col("composition_count") >= F.floor(F.col("payout_count") * share))
    return out.where(keep).drop("__all")


def merged_compositions(frames: list[DataFrame]) -> DataFrame:
    """The compositions of several inputs, equal ones added up."""
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out.groupBy("total", "levels", "payouts", "odds").agg(F.sum("composition_count").alias("composition_count"))
