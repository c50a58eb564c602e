"""Statistics of users over days, weeks and months, and runs within them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwell.functions.columns import band, exact_deviation, exact_mean, period_start, ratio
from driftwell.operators.islands import running, running_group

#: Bands of fish values.
FISH_BANDS = [(10, "low"), (130, "medium"), (200, "high")]


def fan_out(df: DataFrame, group: str = "ai_group") -> DataFrame:
    """Each row once in its own group and once in 'All': overlapping groups in one pass."""
    return df.withColumn(group, F.explode(F.array(F.col(group), F.lit("All"))))


def slot_user_stats(bets: DataFrame, grain: str) -> DataFrame:
    """A row for each period, group and user: counts, sums, hits, table changes and bet changes."""
    w = Window.partitionBy("user_id").orderBy("spin_id", "created_at")
    base = F.col("bet_type") == "BASE"
    bet = F.when(base, F.col("bet_amount"))
    rows = bets.select(
        "*",
        period_start(F.col("created_at"), grain).alias("activity_date"),
        F.when(F.lag("table_id").over(w) != F.col("table_id"), 1).otherwise(0).alias("table_change"),
        (bet - F.lag(bet, 1).over(w)).alias("delta_bet"),
        bet.alias("bet"),
        F.to_date(F.min("created_at").over(Window.partitionBy("user_id"))).alias("first_date"),
    )
    hit = F.col("payout") > 0
    n = lambda c: F.count(F.when(c, 1))
    s = lambda x, c: F.sum(F.when(c, x).otherwise(0.0))
    out = fan_out(rows).groupBy("activity_date", "ai_group", "user_id").agg(
        F.min("first_date").alias("first_date"),
        F.count("*").alias("user_num_bets"),
        n(base).alias("user_num_bets_bg"),
        n(~base).alias("user_num_bets_fg"),
        F.coalesce(F.sum("bet"), F.lit(0.0)).alias("user_total_bet"),
        s(F.col("bet"), base).alias("user_total_bet_bg"),
        s(F.col("bet_amount"), ~base).alias("user_total_bet_fg"),
        F.avg("bet").alias("user_avg_bet_amount"),
        F.sum("payout").alias("user_total_payout"),
        s(F.col("payout"), base).alias("user_total_payout_bg"),
        s(F.col("payout"), ~base).alias("user_total_payout_fg"),
        n(hit).alias("user_num_bets_with_payout"),
        n(hit & base).alias("user_num_bets_bg_with_payout"),
        n(hit & ~base).alias("user_num_bets_fg_with_payout"),
        F.sum("table_change").cast("long").alias("table_changes"),
        s(F.col("delta_bet"), F.col("delta_bet") > 0).alias("pos_delta_bet"),
        s(F.col("delta_bet"), F.col("delta_bet") < 0).alias("neg_delta_bet"),
    )
    age = F.date_diff("activity_date", "first_date")
    return out.withColumn("user_rtp", ratio("user_total_payout", "user_total_bet")).withColumn("user_group", F.when(age <= 3, "new").when(age <= 7, "beginner").otherwise("old"))


def shooter_user_stats(bullets: DataFrame, grain: str) -> DataFrame:
    """A row for each period and user that killed: counts by fish band, profit spread, rooms and the day's group."""
    fish = band(F.col("fish_value"), FISH_BANDS, "ultra")
    profit = F.col("payout") - F.col("bet")
    mean = exact_mean("payout", "bet")  # profits cancel out, so that rounded sums are off or not quite 0
    rows = bullets.withColumn("activity_date", period_start(F.col("event_timestamp"), grain)).withColumn("fish", fish).withColumn("profit", profit)
    bands = [label for _, label in FISH_BANDS] + ["ultra"]
    return rows.groupBy("activity_date", "user_id").agg(
        F.coalesce(F.max(F.when(F.col("strategy_name") == "AI", "AI")), F.min("strategy_name")).alias("daily_group"),
        F.count("*").alias("num_bullets"),
        F.sum("bet").alias("total_bet"),
        F.sum("payout").alias("total_payout"),
        F.sum("killed").cast("long").alias("kills"),
        F.count_distinct("user_id", "room_id").alias("rooms"),
        ratio(exact_deviation("payout", "bet"), F.abs(mean)).alias("profit_cv"),
        *(F.count(F.when(F.col("fish") == b, 1)).alias(f"bullets_{b}") for b in bands),
        F.max("killed").alias("any_kill"),
    ).where("any_kill > 0").drop("any_kill")


def kill_streaks(bullets: DataFrame, gap: int) -> DataFrame:
    """Runs of a user's kills whose neighbours are at most ``gap`` seconds apart."""
    w = Window.partitionBy("user_id").orderBy("event_timestamp", "bullet_id")
    kills = bullets.where("killed = 1")
    far = F.unix_timestamp("event_timestamp") - F.unix_timestamp(F.lag("event_timestamp").over(w)) > gap
    island = kills.withColumn("island", running_group(F.coalesce(far, F.lit(True)), w))
    return island.groupBy("user_id", "island").agg(F.count("*").alias("length"), F.min("event_timestamp").alias("begins"), F.max("event_timestamp").alias("ends"))


def day_sessions(bullets: DataFrame, gap: int) -> DataFrame:
    """Bullets with their session in a day (a gap below ``gap`` continues it), place in it and running return."""
    bullets = bullets.withColumn("day", F.to_date("event_timestamp"))
    w = Window.partitionBy("user_id", "day").orderBy("event_timestamp", "bullet_id")
    far = ~(F.unix_timestamp("event_timestamp") - F.unix_timestamp(F.lag("event_timestamp").over(w)) < gap)
    rows = bullets.withColumn("session", running_group(F.coalesce(far, F.lit(False)), w))
    s = Window.partitionBy("user_id", "day", "session").orderBy("event_timestamp", "bullet_id")
    sofar = running(s)
    return rows.select(
        "*",
        F.row_number().over(s).alias("bet_index"),
        ratio(F.sum("payout").over(sofar), F.sum("bet").over(sofar)).alias("cumulative_rtp"),
        F.sum("killed").over(sofar).alias("killed_sofar"),
        (F.unix_timestamp("event_timestamp") - F.unix_timestamp(F.min("event_timestamp").over(Window.partitionBy("user_id", "day", "session")))).alias("session_seconds"),
    )


def bet_index_curve(sessions: DataFrame, low: int, high: int) -> DataFrame:
    rows = sessions.where(F.col("bet_index").between(low, high))
    r = F.col("cumulative_rtp")
    return rows.groupBy("day", "bet_index", "strategy_name").agg(F.count("*").alias("n"), F.avg(r).alias("rtp_mean"), F.stddev_samp(r).alias("rtp_std"), F.median(r).alias("rtp_median"))


def next_visit(bullets: DataFrame) -> DataFrame:
    """Days with users split by whether they ever come back, and the mean days until they do."""
    days = bullets.select("user_id", F.to_date("event_timestamp").alias("day")).distinct()
    after = days.withColumn("next_day", F.lead("day").over(Window.partitionBy("user_id").orderBy("day")))
    return after.groupBy("day").agg(F.count("*").alias("users"), F.count("next_day").alias("returning"), F.avg(F.date_diff("next_day", "day")).alias("days_until"))


def hour_retention(bullets: DataFrame) -> DataFrame:
    """Of each day's users, those seen again 24 to 48 and 72 to 96 hours after their first shot that day."""
    days = bullets.groupBy("user_id", F.to_date("event_timestamp").alias("day")).agg(F.min("event_timestamp").alias("first"), F.max("event_timestamp").alias("last"))
    # only days that can hold an hour of a window: one to four days later, an equi-join
    again = days.select("user_id", F.explode(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda n: F.date_sub("day", n))).alias("day"), F.col("first").alias("f2"), F.col("last").alias("l2"))
    both = days.join(again, ["user_id", "day"], "left")
    inside = lambda a, b: F.max(F.when((F.col("l2") >= F.col("first") + F.expr(f"INTERVAL {a} HOURS")) & (F.col("f2") < F.col("first") + F.expr(f"INTERVAL {b} HOURS")), 1).otherwise(0))
    one = both.groupBy("user_id", "day").agg(inside(24, 48).alias("d1"), inside(72, 96).alias("d3"))
    return one.groupBy("day").agg(F.count("*").alias("users"), F.sum("d1").alias("day1"), F.sum("d3").alias("day3"))


def ip_stats(bullets: DataFrame, bucket: int = 3600) -> DataFrame:
    """Of each address: users, most users in one bucket of time, days and the mean gap between its events."""
    start = F.floor(F.unix_timestamp("event_timestamp") / bucket)
    most = bullets.groupBy("ip", start.alias("bucket")).agg(F.count_distinct("user_id").alias("u")).groupBy("ip").agg(F.max("u").alias("max_users"))
    w = Window.partitionBy("ip").orderBy("event_timestamp", "bullet_id")
    gap = F.unix_timestamp("event_timestamp") - F.unix_timestamp(F.lag("event_timestamp").over(w))
    rest = bullets.withColumn("gap", gap).groupBy("ip").agg(F.count_distinct("user_id").alias("users"), F.count("*").alias("n"), F.avg("gap").alias("gap_mean"), F.stddev_samp("gap").alias("gap_std"), F.count_distinct("bet").alias("bets"))
    return rest.join(most, "ip")


def milestones(bullets: DataFrame) -> DataFrame:
    """Of each user: first shot, kill and high kill, first change of room, and bullets before the first kill."""
    w = Window.partitionBy("user_id").orderBy("event_timestamp", "bullet_id")
    rows = bullets.select("*", F.lag("room_id").over(w).alias("before"), F.coalesce(F.sum("killed").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("kills_before"))
    ts = F.col("event_timestamp")
    return rows.groupBy("user_id").agg(
        F.min(ts).alias("first_shot"),
        F.min(F.when(F.col("killed") == 1, ts)).alias("first_kill"),
        F.min(F.when((F.col("killed") == 1) & (F.col("fish_value") > 200), ts)).alias("first_high_kill"),
        F.min(F.when(F.col("before") != F.col("room_id"), ts)).alias("first_room_change"),
        F.count(F.when((F.col("kills_before") == 0) & (F.col("killed") == 0), 1)).alias("shots_before_kill"),
        F.min_by("fish_value", F.struct("event_timestamp", "bullet_id")).alias("first_fish"),
    )


def before_first_free(bets: DataFrame) -> DataFrame:
    """BASE bets of each user and day before the day's first free game."""
    w = running(Window.partitionBy("user_id", "day").orderBy("created_at", "spin_id"))
    rows = bets.withColumn("day", F.to_date("created_at")).withColumn("free", F.sum(F.when(F.col("bet_type") == "FREE", 1).otherwise(0)).over(w))
    return rows.groupBy("day", "user_id", "ai_group").agg(F.count(F.when(F.col("free") == 0, F.col("bet_amount"))).alias("bets_before_free"), F.max("free").alias("free_games"))


def left_after_last(bets: DataFrame, group: str = "AI") -> DataFrame:
    """Of each user, day and table of one group: the mean bet of the day's bets after the last spin at the table (none: null).

    One window pass: a running suffix of the day's bets replaces the inequality join."""
    rows = bets.where(F.col("ai_group") == group).withColumn("day", F.to_date("created_at"))
    after = Window.partitionBy("user_id", "day").orderBy("spin_id").rangeBetween(1, Window.unboundedFollowing)
    rows = rows.select("user_id", "day", "table_id", "spin_id", F.avg("bet_amount").over(after).alias("remaining_bet"), F.count("bet_amount").over(after).alias("remaining_bets"))
    return rows.groupBy("user_id", "day", "table_id").agg(F.max_by("remaining_bet", "spin_id").alias("remaining_bet"), F.max_by("remaining_bets", "spin_id").alias("remaining_bets"))


def weekly_compare(daily: DataFrame, date: str, value: str, n: int = 7) -> DataFrame:
    """The mean of the last ``n`` distinct dates against the ``n`` before, and the relative change."""
    place = F.row_number().over(Window.orderBy(F.desc(date)))  # one row a date
    ranked = daily.groupBy(date).agg(F.sum(value).alias("v")).withColumn("place", place)
    mean = lambda a, b: F.avg(F.when(F.col("place").between(a, b), F.col("v")))
    out = ranked.agg(mean(1, n).alias("now"), mean(n + 1, 2 * n).alias("before"))
    return out.withColumn("change", ratio(F.col("now") - F.col("before"), F.col("before")))
