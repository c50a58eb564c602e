"""Queries of returning users, arms, transitions and rounds, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.functions.columns import rounded
from driftwell.operators import cohorts as K
from driftwell.operators import groupstats as G
from driftwell.operators import metrics as M
from driftwell.operators import userstats as U
from driftwell.plans.cohort_queries import _retention_sql
from driftwell.plans.group_queries import _DAY
from driftwell.sources.tables import BETS_SQL, BULLETS_SQL, bets, bullets, load

GAP = 21_600


def _bullets(build):
    return lambda spark, d: rounded(build(bullets(load(spark, d, "events"))))


def _arms(spark, d):
    e = load(spark, d, "events")
    quoted = F.concat(F.lit('"""'), F.upper(F.md5((F.col("event_id") % 5).cast("string").cast("binary"))), F.lit('"""'))
    mapping = e.where("user_id % 3 <> 0").select(quoted.alias("ab_group_id"), F.col("user_id").cast("string").alias("user_id"), "event_id")
    return K.with_arms(e.groupBy("user_id").agg(F.count("*").alias("n")), mapping, [F.asc("event_id")])


def _transitions(spark, d):
    rows = G.period_columns(bets(load(spark, d, "events")), "created_at").select("user_id", "week", "day").distinct()
    labels = rows.unionByName(rows).select("user_id", "week", "day", (F.dayofmonth("day") % 3).alias("cluster_label"))
    return K.bin_transitions(rows, labels, ["user_id", "week"], "day")


def _rounds(spark, d):
    rows = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("payout"), F.when(F.col("l_orderkey") % 17 != 0, F.col("l_extendedprice")).otherwise(0.0).alias("account"))
    return K.round_payouts(K.whole_rounds(rows, ["l_orderkey"], "account", "l_linenumber", 2), ["l_orderkey"], "l_linenumber", "payout")


def _compositions(spark, d):
    rows = _rounds(spark, d).where("levels <= 3").select(F.transform("payouts", lambda p: p - p % 10).alias("payouts"), "levels")
    found = K.compositions(rows.withColumn("total", F.aggregate("payouts", F.lit(0).cast("long"), lambda s, x: s + x)))
    found = K.without_rare(K.merged_compositions([found, found]), 0.002)
    return found.select("total", "levels", F.array_join("payouts", ",").alias("payouts"), F.array_join("odds", ",").alias("odds"), "composition_count", "payout_count")


def _ages(spark, d):
    stats = U.slot_user_stats(bets(load(spark, d, "events")), "day")
    return stats.select("activity_date", "ai_group", "user_id", K.age_group(F.date_diff("activity_date", "first_date")).alias("user_group2"))


def _month(spark, d):
    return rounded(M.retention(U.slot_user_stats(bets(load(spark, d, "events")), "day"), ["ai_group"], "activity_date", "month"))


def _report(spark, d):
    c = load(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    return K.report_rows(c, "day", "1997-06-01", {"o_orderpriority": ["1-URGENT", "5-LOW"], "o_orderstatus": ["O", "F"]}).select("o_orderkey", "day", "o_orderpriority", "o_orderstatus")


QUERIES = {
    "returns": lambda s, d: K.returns(bullets(load(s, d, "events"))),
    "returns_by_play": _bullets(lambda b: K.returns_by_play(b, GAP)),
    "retention_exact_forward": lambda s, d: K.forward_retention(G.day_group(bullets(load(s, d, "events"))), "daily_group"),
    "retention_horizon_month": _month,
    "ab_arms": _arms,
    "bin_transitions": _transitions,
    "resampled_return": _bullets(lambda b: K.resampled_return(b, "event_timestamp", "strategy_name", "payout", "bet", "6 hours")),
    "report_rows": _report,
    "user_ages": _ages,
    "round_payouts": lambda s, d: _rounds(s, d).select("l_orderkey", "total", "levels", F.array_join("payouts", ",").alias("payouts")),
    "payout_compositions": _compositions,
}

_R = lambda e, n, p=6: f"round(CAST({e} AS DOUBLE), {p}) + 0.0 AS {n}"
_B = f"WITH {BULLETS_SQL}"
_RETURNS = """dy AS (SELECT user_id, CAST(event_timestamp AS DATE) AS day, min(event_timestamp) AS f, max(event_timestamp) AS l FROM bullets GROUP BY ALL),
re AS (SELECT a.user_id, a.day, max(CASE WHEN b.l >= a.f + INTERVAL 24 HOUR AND b.f < a.f + INTERVAL 48 HOUR THEN 1 ELSE 0 END) AS day1_return, max(CASE WHEN b.l >= a.f + INTERVAL 72 HOUR AND b.f < a.f + INTERVAL 96 HOUR THEN 1 ELSE 0 END) AS day3_return,
  max(CASE WHEN date_trunc('week', b.day) = date_trunc('week', a.day) + INTERVAL 7 DAY THEN 1 ELSE 0 END) AS week1_return, max(CASE WHEN date_trunc('month', b.day) = date_trunc('month', a.day) + INTERVAL 1 MONTH THEN 1 ELSE 0 END) AS month1_return FROM dy a JOIN dy b USING (user_id) GROUP BY a.user_id, a.day)"""
_CASE = lambda x, bands, other: "CASE " + " ".join(f"WHEN {x} <= {e} THEN '{n}'" for e, n in bands) + f" ELSE '{other}' END"
_SHARE = ", ".join(_R(f"count(DISTINCT CASE WHEN {c}_return = 1 THEN user_id END) / count(DISTINCT user_id)", f"{c}_retention_ratio") for c in ("day1", "day3", "week1", "month1"))
_MULT = "CASE i WHEN 1 THEN 2 WHEN 2 THEN 4 WHEN 3 THEN 6 ELSE 10 END"
_ROUNDS = """r AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS payout, CASE WHEN l_orderkey % 17 <> 0 THEN l_extendedprice ELSE 0.0 END AS account FROM lineitem),
o AS (SELECT l_orderkey, list(payout ORDER BY l_linenumber, payout) AS payouts, CAST(sum(payout) AS BIGINT) AS total, CAST(count(*) AS INTEGER) AS levels FROM r GROUP BY l_orderkey HAVING max(account) <> 0 AND max(l_linenumber) >= 2)"""
SQL = {
    "returns": f"{_B}, {_RETURNS} SELECT * FROM re",
    "returns_by_play": f"""{_B}, {_RETURNS}, ba AS (SELECT *, {_CASE("fish_value", K.FISH_BANDS, "ultra")} AS fish_type, CASE WHEN epoch_us(event_timestamp) - lag(epoch_us(event_timestamp)) OVER (PARTITION BY user_id ORDER BY event_timestamp, bullet_id) <= {GAP}000000 THEN 0 ELSE 1 END AS brk FROM bullets),
      se AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY event_timestamp, bullet_id ROWS UNBOUNDED PRECEDING) AS session FROM ba),
      ti AS (SELECT user_id, CAST(event_timestamp AS DATE) AS day, fish_type, (epoch_us(event_timestamp) - epoch_us(min(event_timestamp) OVER (PARTITION BY user_id, session))) / 1e6 AS s, sum(killed) OVER (PARTITION BY user_id, session, fish_type ORDER BY event_timestamp, bullet_id ROWS UNBOUNDED PRECEDING) AS k FROM se),
      wi AS (SELECT user_id, day, fish_type, {_CASE("s", K.TIME_BANDS, ">10_min")} AS time_window, {_CASE("k", K.KILL_BANDS, "kill_fish_>10")} AS kill_fish FROM ti) SELECT fish_type, time_window, kill_fish, count(DISTINCT user_id) AS num_users, {_SHARE} FROM wi JOIN re USING (user_id, day) GROUP BY ALL""",
    "retention_exact_forward": f"""{_B}, {_DAY} SELECT t.daily_group, t.activity_date, count(DISTINCT t.user_id) AS num_users_day0, {", ".join(f"count(DISTINCT t{n}.user_id) AS num_users_day{n}" for n in (1, 3, 7))} FROM daygroup t
      {" ".join(f"LEFT JOIN daygroup t{n} ON t{n}.user_id = t.user_id AND t{n}.activity_date = t.activity_date + {n}" for n in (1, 3, 7))} GROUP BY ALL""",
    "retention_horizon_month": _retention_sql("month"),
    "ab_arms": """WITH m AS (SELECT user_id, arg_min(upper(md5(CAST(event_id % 5 AS VARCHAR))), event_id) AS ab_group_id FROM events WHERE user_id % 3 <> 0 GROUP BY user_id), s AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)
      SELECT user_id, n, ab_group_id, lower(left(ab_group_id, 4)) AS ab_arm FROM s LEFT JOIN m USING (user_id)""",
    "bin_transitions": f"""WITH {BETS_SQL}, d AS (SELECT DISTINCT user_id, CAST(date_trunc('week', created_at) AS DATE) AS week, CAST(created_at AS DATE) AS day FROM bets), n AS (SELECT *, CAST(day(day) % 3 AS INTEGER) AS cluster_label, lead(CAST(day(day) % 3 AS INTEGER)) OVER (PARTITION BY user_id, week ORDER BY day) AS next_cluster FROM d)
      SELECT *, 'cluster' || cluster_label || ':' || next_cluster AS transition FROM n WHERE next_cluster IS NOT NULL""",
    "resampled_return": f"{_B} SELECT time_bucket(INTERVAL 6 HOUR, event_timestamp, TIMESTAMP '1970-01-01') AS start, strategy_name, {_R('sum(payout) / sum(bet)', 'rtp')} FROM bullets GROUP BY ALL HAVING sum(bet) <> 0",
    "report_rows": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderpriority, o_orderstatus FROM orders WHERE CAST(o_orderdate AS DATE) >= '1997-06-01' AND o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus IN ('O', 'F')",
    "user_ages": f"""WITH {BETS_SQL}, f AS (SELECT *, CAST(min(created_at) OVER (PARTITION BY user_id) AS DATE) AS first, CAST(created_at AS DATE) AS activity_date, unnest([ai_group, 'All']) AS g FROM bets)
      SELECT DISTINCT activity_date, g AS ai_group, user_id, CASE WHEN activity_date - first < 1 THEN 'day0_user' WHEN activity_date - first < 7 THEN 'day1-6_user' ELSE 'day7+_user' END AS user_group2 FROM f""",
    "round_payouts": f"WITH {_ROUNDS} SELECT l_orderkey, total, levels, array_to_string(payouts, ',') AS payouts FROM o",
    "payout_compositions": f"""WITH {_ROUNDS}, p AS (SELECT list_transform(payouts, lambda x: x - x % 10) AS payouts, levels FROM o WHERE levels <= 3), c AS (SELECT CAST(list_sum(payouts) AS BIGINT) AS total, levels, payouts, 2 * count(*) AS n FROM p GROUP BY ALL),
      t AS (SELECT *, CAST(sum(n) OVER (PARTITION BY total) AS BIGINT) AS payout_count, sum(n) OVER () AS al FROM c)
      SELECT total, levels, array_to_string(payouts, ',') AS payouts, array_to_string(list_transform(payouts, lambda x, i: CAST(floor(x / ({_MULT})) AS BIGINT)), ',') AS odds, n AS composition_count, payout_count FROM t WHERE payout_count >= floor(al * 0.002::DOUBLE) AND n >= floor(payout_count * 0.002::DOUBLE)""",
}
