"""Queries of group, period and cohort statistics, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.functions.columns import rounded
from driftwell.operators import groupstats as G
from driftwell.operators import metrics as M
from driftwell.operators import userstats as U
from driftwell.operators.prep import policy
from driftwell.plans.cohort_queries import _slots
from driftwell.sources.tables import BETS_SQL, BULLETS_SQL, TRANSACTIONS_SQL, bets, bullets, load, transactions

GAP, BOOT = 21_600, 100


def _bets(build, places: int = 6):
    return lambda spark, d: rounded(build(bets(load(spark, d, "events"))), places)


def _bullets(build, places: int = 6):
    return lambda spark, d: rounded(build(bullets(load(spark, d, "events"))), places)


def _events(build, places: int = 6):
    return lambda spark, d: rounded(build(load(spark, d, "events")), places)


def _with_sessions(b):
    keys = ["activity_date", "user_id"]
    return G.with_sessions(U.shooter_user_stats(b, "day").select(*keys, "num_bullets"), G.session_days(b, GAP).select(*keys, "num_sessions", "avg_length"), G.streak_days(b), keys)


def _monthly(b):
    return G.daily_to_monthly(U.slot_user_stats(b, "day"), ["ai_group"], "activity_date", ["user_total_bet", "user_rtp"])


def _incentives(b):
    arm = F.col("ai_group")
    limit = F.when(arm == "AI", 2).when(arm == "Default", 1)
    rtp = F.when(arm == "AI", 0.5).when(arm == "Default", 0.9)
    return G.incentive_days(G.spin_stats(b), limit, rtp, F.col("user_id") % 7 == 0)


def _first(spark, d):
    e = load(spark, d, "events")
    return G.first_events(bullets(e), transactions(e), 150)


def _histogram(spark, d):
    return G.event_histogram(_first(spark, d), "first_bet", ["first_kill", "first_high_kill", "change_device", "first_deposit", "stop_play"], 3_600)


def _cohort(spark, d):
    b = bullets(load(spark, d, "events"))
    cohort = b.groupBy("user_id").agg(F.min("event_timestamp").alias("first_play")).where("user_id % 2 = 0")
    return G.first_sessions(b, cohort, 72, 43_200)


def _clusters(spark, d):
    rows = load(spark, d, "events").select((F.col("user_id") % 4).alias("cluster"), "user_id", "ts", F.when(F.col("event_id") % 9 != 0, F.col("value") - 20).alias("basepoint"), F.get_json_object("props", "$.k").cast("long").alias("amount"))
    return rounded(G.cluster_stats(rows, "cluster", "basepoint", "amount", "user_id", "ts"))


def _rooms(b):
    rows = b.withColumn("day", F.to_date("event_timestamp"))
    return rows.groupBy("day", "room_id").agg(F.avg("bet").alias("bet"), F.avg("payout").alias("payout"))


def _numbers(spark, d):
    cells = [F.concat_ws(", ", (F.col("p_partkey") % 97).cast("string"), F.lit("x"), (F.col("p_size") * 3).cast("string")).alias("a"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("-1,"), F.col("p_size").cast("string"))).alias("b")]
    return G.distinct_numbers(load(spark, d, "part").select(*cells), ["a", "b"])


def _stored(spark, d):
    rows = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return rounded(G.standardised(rows, {"l_quantity": (25.0, 14.0), "l_discount": (0.05, 0.0), "l_tax": (0.04, 0.026)}))


def _approximate(spark, d):
    return G.approximate_percentiles(load(spark, d, "lineitem"), ["l_returnflag"], "l_quantity")


def _ranges(spark, d):
    stats = U.slot_user_stats(bets(load(spark, d, "events")), "day").where("ai_group = 'All'")
    ranged = G.in_ranges(stats, "activity_date", G.last_ranges(stats, "activity_date", 10))
    return rounded(G.bootstrap_ci(ranged, ["range"], "user_total_bet", F.concat_ws("|", "activity_date", "user_id"), BOOT), 5)


def _extended(b):
    stats = U.slot_user_stats(b, "day")
    keys = ["activity_date", "ai_group"]
    return G.extended(stats.select(*keys, "user_id", "user_num_bets", "user_total_bet", "user_group"), keys, M.metrics(stats, keys, ["rtp", "num_new_users"]))


def _plot(spark, d):
    stats = U.slot_user_stats(bets(load(spark, d, "events")), "day")
    keys = ["activity_date", "ai_group"]
    out = G.plot_values(stats, M.metrics(stats, keys, ["rtp"]), keys, "user_num_bets", stats.where("ai_group = 'AI'"), BOOT)
    return rounded(out, 5)


def _thin(b):
    return G.thinned(b.select("user_id", "spin_id", "payout"), ["user_id"], ["spin_id"], 10)


def _control(spark, d):
    c = load(spark, d, "customer")
    return G.sampled(c, 20, c.where("c_acctbal < 0"), "c_custkey", 7)


def _profit_order(b):
    return b.groupBy("user_id").agg(F.sum(F.col("payout") - F.col("bet_amount")).alias("profit")).orderBy(F.desc("profit"), "user_id")


def _years(spark, d):
    rows = load(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"), "o_orderpriority", "o_totalprice", F.lit(1).alias("orders"))
    names = {"1-URGENT": "urgent", "2-HIGH": "high", "5-LOW": "low"}
    return rounded(G.year_report(rows, "day", "o_orderpriority", list(names), ["o_totalprice", "orders"], names), 4)


QUERIES = {
    "day_groups": lambda s, d: G.day_group(bullets(load(s, d, "events"))),
    "session_groups": lambda s, d: G.session_group(U.day_sessions(bullets(load(s, d, "events")), GAP)),
    "session_days": _bullets(lambda b: G.session_days(b, GAP)),
    **{f"period_sessions_{g}": _bullets(lambda b, g=g: G.period_sessions(b, GAP, g)) for g in ("week", "month")},
    "streak_days": _bullets(G.streak_days),
    "stats_with_sessions": _bullets(_with_sessions),
    "daily_to_monthly": _bets(_monthly),
    "group_days": _bets(lambda b: G.group_days(b, 8), 3),
    "policy_stats": _bets(lambda b: G.policy_stats(b, policy(F.col("created_at"), "2024-01-15 12:00:00"), 8), 9),
    "group_rtp_median": _bets(lambda b: G.group_rtp(U.slot_user_stats(b, "day"), ["activity_date", "ai_group"])),
    "spin_stats": _bets(G.spin_stats),
    "incentive_days": _bets(_incentives),
    "incentive_summary": _bets(lambda b: G.incentive_summary(_incentives(b))),
    "incentive_rollup": _bets(lambda b: G.incentive_rollup(G.incentive_summary(_incentives(b)), F.when(F.col("ai_group") == "AI", "ai").otherwise("other"))),
    "first_events": _first,
    "event_histogram": _histogram,
    "first_sessions": _cohort,
    "address_stats": _bullets(G.address_stats, 3),
    "cluster_stats": _clusters,
    "room_day_means": _bullets(_rooms),
    "user_times": _events(lambda e: G.user_times(e, "user_id", "ts", 43_200), 2),
    "change_across": _events(lambda e: G.change_across(e.withColumn("day", F.to_date("ts")), "day", "event_type", "view", "click", "value")),
    "seasons": _events(lambda e: G.seasons(e, "ts", "value")),
    "sign_split": _events(lambda e: G.signs(e.withColumn("x", F.when(F.col("event_id") % 6 == 0, 0.0).otherwise(F.col("value") - 25)), "event_type", "x")),
    "distinct_numbers": _numbers,
    "stored_z_scores": _stored,
    "approximate_percentiles": _approximate,
    "range_means": _ranges,
    "extended_metrics": _bets(_extended, 9),
    "plot_values": _plot,
    "downsample": _bets(_thin),
    "control_sample": _control,
    "users_by_profit": _bets(_profit_order),
    "year_report": _years,
    "period_columns": _bets(lambda b: G.period_columns(b, "created_at").select("spin_id", "day", "week", "month")),
}

_R = lambda e, n, p=6: f"round(CAST({e} AS DOUBLE), {p}) + 0.0 AS {n}"
_B, _S = f"WITH {BULLETS_SQL}", f"WITH {BETS_SQL}"
_BANDS = {"low": "fish_value <= 10", "medium": "fish_value > 10 AND fish_value <= 130", "high": "fish_value > 130 AND fish_value <= 200", "ultra": "fish_value > 200"}
_DAY = "daygroup AS (SELECT user_id, CAST(event_timestamp AS DATE) AS activity_date, coalesce(max(CASE WHEN strategy_name = 'AI' THEN 'AI' END), min(strategy_name)) AS daily_group FROM bullets GROUP BY ALL)"
_SESSIONS = f"""dd AS (SELECT *, CAST(event_timestamp AS DATE) AS activity_date FROM bullets),
gg AS (SELECT *, CASE WHEN date_diff('second', lag(event_timestamp) OVER w, event_timestamp) >= {GAP} THEN 1 ELSE 0 END AS brk FROM dd WINDOW w AS (PARTITION BY user_id, activity_date ORDER BY event_timestamp, bullet_id)),
hh AS (SELECT *, sum(brk) OVER (PARTITION BY user_id, activity_date ORDER BY event_timestamp, bullet_id ROWS UNBOUNDED PRECEDING) AS session FROM gg)"""
_KILLS = {"": "killed", **{f"_{b}": f"CASE WHEN {c} THEN killed ELSE 0 END" for b, c in _BANDS.items()}}
_SESSION_DAYS = f"""{_SESSIONS}, ss AS (SELECT user_id, activity_date, session, count(*) AS bullets, date_diff('second', min(event_timestamp), max(event_timestamp)) AS length, {", ".join(f"sum({c}) AS kills{b}" for b, c in _KILLS.items())} FROM hh GROUP BY ALL),
sd AS (SELECT user_id, activity_date, count(*) AS num_sessions, avg(length) AS avg_length, max(length) AS max_length, min(length) AS min_length,
  {", ".join(f"avg(length / nullif(kills{b}, 0)) AS seconds_to_kill{b}" for b in _KILLS)}, {", ".join(f"avg(bullets / nullif(kills{b}, 0)) AS bets_to_kill{b}" for b in _KILLS)} FROM ss GROUP BY ALL)"""
_PER = [f"{x}_to_kill{b}" for x in ("seconds", "bets") for b in _KILLS]
_KINDS = ("all", "low", "medium", "high", "ultra")
_STREAKS = f"""kk AS (SELECT *, CAST(event_timestamp AS DATE) AS activity_date, unnest(['all', CASE {" ".join(f"WHEN {c} THEN '{b}'" for b, c in _BANDS.items())} END]) AS kind FROM bullets),
rr AS (SELECT *, sum(CASE WHEN killed = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, activity_date, kind ORDER BY event_timestamp, bullet_id ROWS UNBOUNDED PRECEDING) AS run FROM kk),
nn AS (SELECT user_id, activity_date, kind, run, count(*) AS n FROM rr WHERE killed = 1 GROUP BY ALL),
st AS (SELECT user_id, activity_date, {", ".join(f"max(n) FILTER (kind = '{k}') AS max_streak_{k}" for k in _KINDS)}, {", ".join(_R(f"avg(n) FILTER (kind = '{k}')", f"avg_streak_{k}") for k in _KINDS)} FROM nn GROUP BY ALL)"""


def _period_sql(grain: str) -> str:
    return f"""{_B}, {_DAY}, {_SESSION_DAYS} SELECT CAST(date_trunc('{grain}', activity_date) AS DATE) AS activity_date, daily_group, user_id, CAST(sum(num_sessions) AS BIGINT) AS user_num_sessions, {_R("avg(avg_length)", "user_avg_length")},
      max(max_length) AS user_max_length, min(min_length) AS user_min_length, {", ".join(_R(f"avg({c})", f"user_{c}") for c in _PER)} FROM sd JOIN daygroup USING (user_id, activity_date) GROUP BY 1, 2, 3"""


_FAN = "f AS (SELECT * REPLACE (unnest([ai_group, 'All']) AS ai_group) FROM u)"
_USERS = "u AS (SELECT *, CAST(created_at AS DATE) AS day, count(*) OVER (PARTITION BY user_id) AS user_bets, (epoch_us(created_at) - lag(epoch_us(created_at)) OVER (PARTITION BY user_id ORDER BY created_at, spin_id)) / 1e6 AS gap, CASE WHEN created_at <= '2024-01-15 12:00:00' THEN 'origin' ELSE 'updated' END AS math_policy FROM bets)"
_SPINS = """spins AS (SELECT day, ai_group, user_id, table_id, bet_type, count(*) AS spin_count, sum(bet_amount) AS bet, sum(payout) AS win, sum(payout) / nullif(sum(bet_amount), 0) AS rtp FROM u GROUP BY ALL)"""
_INC = f"""{_S}, {_USERS}, {_SPINS}, lim AS (SELECT *, CASE ai_group WHEN 'AI' THEN 2 WHEN 'Default' THEN 1 END AS spin_thresh, CASE ai_group WHEN 'AI' THEN 0.5 WHEN 'Default' THEN 0.9 END AS rtp_thresh, user_id % 7 = 0 AS inc FROM spins),
ud AS (SELECT day, ai_group, user_id, CAST(sum(CASE WHEN bet_type = 'BASE' THEN spin_count ELSE 0 END) AS BIGINT) AS total_spin, bool_or(bet_type <> 'BASE') AS has_any_non_base, bool_or(bet_type <> 'BASE' AND NOT inc) AS has_fg, bool_or(inc) AS has_incentivized,
  min(spin_thresh) AS spin_thresh, min(rtp_thresh) AS rtp_thresh, avg(rtp) FILTER (bet_type = 'BASE') AS rtp FROM lim WHERE spin_thresh IS NOT NULL GROUP BY ALL),
fl AS (SELECT *, total_spin < spin_thresh AS low_spin, total_spin >= spin_thresh AND coalesce(rtp > rtp_thresh, false) AS high_rtp, total_spin > spin_thresh AND coalesce(rtp > rtp_thresh, false) AS pass_incentive_thresh,
  NOT has_any_non_base AND NOT has_incentivized AS no_fg_not_incentivized, total_spin >= spin_thresh AND coalesce(rtp > rtp_thresh, false) AND has_incentivized AS high_rtp_incentivized FROM ud)"""
_SHARES = ", ".join(_R(f"{n} / nullif(num_users, 0)", n.replace("num_users_", "ratio_users_").replace("num_user_", "ratio_user_")) for n in G.FLAGS)
_SUMMARY = f"""{_INC}, sm AS (SELECT day, ai_group, count(*) AS num_users, {", ".join(f"count(*) FILTER ({c}) AS {n}" for n, c in G.FLAGS.items())}, median(total_spin) FILTER (low_spin) AS median_spin_below_thresh,
  avg(rtp) FILTER (no_fg_not_incentivized) AS mean_rtp_no_fg_not_incentivized, avg(total_spin) FILTER (no_fg_not_incentivized) AS avg_base_spin_no_fg_not_incentivized FROM fl GROUP BY ALL)"""
_MEANS = ("median_spin_below_thresh", "mean_rtp_no_fg_not_incentivized", "avg_base_spin_no_fg_not_incentivized")
_FIRST = f"""{_B}, {TRANSACTIONS_SQL}, fo AS (SELECT user_id, arg_min(device_type, bullet_id) FILTER (device_type IS NOT NULL) AS d0, arg_min(ip, bullet_id) FILTER (ip IS NOT NULL) AS i0 FROM bullets GROUP BY user_id),
ow AS (SELECT user_id, min(event_timestamp) AS first_bet, max(event_timestamp) AS stop_play, arg_min(strategy_name, event_timestamp) AS strategy_group, min(event_timestamp) FILTER (payout > 0) AS first_kill,
  min(event_timestamp) FILTER (payout > 0 AND fish_value >= 150) AS first_high_kill, min(event_timestamp) FILTER (device_type <> d0) AS change_device, min(event_timestamp) FILTER (ip <> i0) AS change_ip FROM bullets JOIN fo USING (user_id) GROUP BY user_id),
mo AS (SELECT *, row_number() OVER (PARTITION BY user_id, type ORDER BY processed_at) AS n FROM (SELECT DISTINCT user_id, type, processed_at FROM transactions WHERE amount > 0)),
mm AS (SELECT user_id, min(processed_at) FILTER (type = 0 AND n = 1) AS first_deposit, min(processed_at) FILTER (type = 0 AND n = 2) AS second_deposit, min(processed_at) FILTER (type = 1 AND n = 1) AS first_withdrawal FROM mo GROUP BY user_id),
fe AS (SELECT * FROM ow LEFT JOIN mm USING (user_id))"""
_NAMES = ("first_kill", "first_high_kill", "change_device", "first_deposit", "stop_play")
_CASE = "CASE " + " ".join(f"WHEN draw < {e} THEN {n}" for n, e in enumerate(G.POISSON[:-1])) + f" ELSE {len(G.POISSON) - 1} END"


def _boot(source: str, by: str, value: str, key: str) -> str:
    """CTEs bt (by, n, mean, median, low, high, lower, upper) over rows of ``source``."""
    words = -(-BOOT // 8)
    return f"""br AS (SELECT {by}, CAST({value} AS DOUBLE) AS x, {key} AS key FROM {source} WHERE {value} IS NOT NULL),
bw AS (SELECT {by}, x, j, md5(key || '|' || j) AS word FROM br, range({words}) t(j)),
bd AS (SELECT {by}, x, j * 8 + i AS b, CAST(('0x' || substr(word, CAST(4 * i + 1 AS BIGINT), 4)) AS INTEGER) AS draw FROM bw, range(8) t(i)),
bm AS (SELECT {by}, b, sum(x * {_CASE}) AS s, sum({_CASE}) AS w FROM bd WHERE b < {BOOT} GROUP BY {by}, b),
bq AS (SELECT {by}, quantile_cont(s / w, 0.025) AS lower, quantile_cont(s / w, 0.975) AS upper FROM bm WHERE w > 0 GROUP BY {by}),
bo AS (SELECT {by}, count(*) AS n, avg(x) AS mean, median(x) AS median, min(x) AS low, max(x) AS high FROM br GROUP BY {by}),
bt AS (SELECT bo.* , CASE WHEN n >= 2 THEN coalesce(lower, mean) ELSE mean END AS lower, CASE WHEN n >= 2 THEN coalesce(upper, mean) ELSE mean END AS upper FROM bo LEFT JOIN bq USING ({by}))"""


_STATS = f"WITH {_slots('day').rpartition('|')[0]}"
_PRIORITIES = {"1-URGENT": "urgent", "2-HIGH": "high", "5-LOW": "low"}
_SUMS = lambda p: f"count(*) AS {p}num_bets, count(*) FILTER (bet_type = 'BASE') AS {p}num_bets_bg, count(*) FILTER (bet_type <> 'BASE') AS {p}num_bets_fg, sum(bet_amount) AS {p}total_bet, sum(payout) AS {p}total_payout, sum(payout) FILTER (bet_type = 'BASE') AS {p}total_payout_bg"
_ROUND = ", ".join(_R(f"{p}{c}", f"{p}{c}") for p in ("user_", "group_") for c in ("total_bet", "total_payout", "total_payout_bg"))
SQL = {
    "day_groups": f"{_B}, {_DAY} SELECT * FROM daygroup",
    "session_groups": f"{_B}, {_SESSIONS} SELECT user_id, activity_date AS day, CAST(session AS BIGINT) AS session, CASE WHEN count(*) FILTER (strategy_name = 'AI') > 0 THEN 'AI' WHEN count(*) FILTER (strategy_name = 'Default') > 0 THEN 'Default' ELSE min(strategy_name) END AS session_group, count(*) AS bullets FROM hh GROUP BY user_id, activity_date, session",
    "session_days": f"{_B}, {_SESSION_DAYS} SELECT * REPLACE ({', '.join(_R(c, c) for c in ('avg_length', *_PER))}) FROM sd",
    **{f"period_sessions_{g}": _period_sql(g) for g in ("week", "month")},
    "streak_days": f"{_B}, {_STREAKS} SELECT * FROM st",
    "stats_with_sessions": f"""{_B}, {_SESSION_DAYS}, {_STREAKS}, n AS (SELECT user_id, activity_date, count(*) AS num_bullets FROM dd GROUP BY ALL HAVING max(killed) > 0)
      SELECT n.*, num_sessions, {_R("avg_length", "avg_length")}, st.* EXCLUDE (user_id, activity_date) FROM n LEFT JOIN sd USING (user_id, activity_date) LEFT JOIN st USING (user_id, activity_date)""",
    "daily_to_monthly": f"""{_STATS}, d AS (SELECT ai_group, activity_date, user_id, avg(user_total_bet) AS user_total_bet, avg(user_rtp) AS user_rtp FROM s GROUP BY ALL)
      SELECT ai_group, CAST(date_trunc('month', activity_date) AS DATE) AS month, {_R("avg(user_total_bet)", "user_total_bet")}, {_R("avg(user_rtp)", "user_rtp")}, count(DISTINCT user_id) AS users FROM d GROUP BY 1, 2""",
    "group_days": f"""{_S}, {_USERS}, {_FAN}, st AS (SELECT day, ai_group, count(DISTINCT user_id) AS num_active_users, count(*) AS num_bets, count(*) FILTER (bet_type = 'BASE') AS num_bets_bg, count(*) FILTER (bet_type = 'FREE') AS num_bets_fg, {_R("sum(bet_amount)", "total_bet", 3)},
        {_R("sum(bet_amount) FILTER (bet_type = 'BASE')", "total_bet_bg", 3)}, {_R("sum(payout)", "total_payout", 3)}, {_R("sum(payout) FILTER (bet_type = 'BASE')", "total_payout_bg", 3)}, {_R("sum(payout) FILTER (bet_type = 'FREE')", "total_payout_fg", 3)}, {_R("avg(gap) FILTER (gap BETWEEN 0 AND 86400)", "avg_delta_t_seconds", 3)}
        FROM f WHERE user_bets >= 8 GROUP BY ALL), l AS (SELECT DISTINCT day, ai_group, user_id FROM f), dy AS (SELECT DISTINCT day, user_id FROM f),
      k AS (SELECT l.day, l.ai_group, count(*) AS day0_num_users, count(a.user_id) AS day1_num_users, count(c.user_id) AS day3_num_users FROM l LEFT JOIN dy a ON a.user_id = l.user_id AND a.day = l.day - 1 LEFT JOIN dy c ON c.user_id = l.user_id AND c.day = l.day - 3 GROUP BY ALL)
      SELECT * FROM st JOIN k USING (day, ai_group)""",
    "policy_stats": f"""{_S}, {_USERS}, {_FAN}, us AS (SELECT day, ai_group, math_policy, user_id, {_SUMS("user_")} FROM f WHERE user_bets >= 8 GROUP BY ALL), gs AS (SELECT day, ai_group, math_policy, count(DISTINCT user_id) AS num_active_users, {_SUMS("group_")} FROM f WHERE user_bets >= 8 GROUP BY ALL)
      SELECT us.* REPLACE ({", ".join(_R(f"user_{c}", f"user_{c}", 9) for c in ("total_bet", "total_payout", "total_payout_bg"))}), gs.* EXCLUDE (day, ai_group, math_policy) REPLACE ({", ".join(_R(f"group_{c}", f"group_{c}", 9) for c in ("total_bet", "total_payout", "total_payout_bg"))}),
        {_R("group_total_bet / nullif(num_active_users, 0)", "total_bet_per_user", 9)}, {_R("user_num_bets_fg / nullif(user_num_bets, 0)", "user_fg_ratio", 9)}, {_R("user_total_payout / nullif(user_total_bet, 0)", "user_rtp", 9)}, {_R("user_total_payout_bg / nullif(user_total_bet, 0)", "user_rtp_bg", 9)},
        {_R("group_total_payout / nullif(group_total_bet, 0)", "rtp", 9)}, {_R("group_total_payout_bg / nullif(group_total_bet, 0)", "rtp_bg", 9)}, {_R("(group_total_payout - group_total_bet) / nullif(num_active_users, 0)", "total_profit_per_user", 9)} FROM us JOIN gs USING (day, ai_group, math_policy)""",
    "group_rtp_median": f"{_STATS} SELECT activity_date, ai_group, {_R('median(user_rtp)', 'rtp_median')}, {_R('sum(user_total_payout) / nullif(sum(user_total_bet), 0)', 'rtp')} FROM s GROUP BY ALL",
    "spin_stats": f"{_S}, {_USERS}, {_SPINS}, a AS (SELECT day, ai_group, {_R('count(*) / nullif(count(DISTINCT user_id), 0)', 'spins_per_user')} FROM u GROUP BY ALL) SELECT spins.* REPLACE ({', '.join(_R(c, c) for c in ('bet', 'win', 'rtp'))}), spins_per_user FROM spins JOIN a USING (day, ai_group)",
    "incentive_days": f"{_INC} SELECT * REPLACE ({_R('rtp', 'rtp')}, {_R('rtp_thresh', 'rtp_thresh')}) FROM fl",
    "incentive_summary": f"{_SUMMARY} SELECT * REPLACE ({', '.join(_R(c, c) for c in _MEANS)}), {_SHARES} FROM sm",
    "incentive_rollup": f"""{_SUMMARY}, ar AS (SELECT day, CASE WHEN ai_group = 'AI' THEN 'ai' ELSE 'other' END AS arm, {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("num_users", *G.FLAGS))}, {", ".join(f"avg({c}) AS {c}" for c in _MEANS)} FROM sm GROUP BY 1, 2)
      SELECT * REPLACE ({", ".join(_R(c, c) for c in _MEANS)}), {_SHARES} FROM ar""",
    "first_events": f"{_FIRST} SELECT * FROM fe",
    "event_histogram": f"""{_FIRST}, lo AS ({" UNION ALL ".join(f"SELECT '{n}' AS event, greatest((epoch_us({n}) - epoch_us(first_bet)) / 1e6, 0) AS o FROM fe WHERE {n} IS NOT NULL" for n in _NAMES)})
      SELECT event, CAST(CASE WHEN o < 86400 THEN floor(o / 3600) ELSE 24 + floor(o / 86400) - 1 END AS BIGINT) AS bin_index, count(*) AS n FROM lo GROUP BY ALL""",
    "first_sessions": f"""{_B}, co AS (SELECT user_id, min(event_timestamp) AS first_play FROM bullets WHERE user_id % 2 = 0 GROUP BY user_id), ins AS (SELECT * FROM bullets JOIN co USING (user_id) WHERE event_timestamp >= first_play AND event_timestamp < first_play + INTERVAL 72 HOUR),
      br AS (SELECT *, lead(event_timestamp) OVER w AS next_ts, CASE WHEN date_diff('second', lag(event_timestamp) OVER w, event_timestamp) >= 43200 THEN 1 ELSE 0 END AS brk FROM ins WINDOW w AS (PARTITION BY user_id ORDER BY event_timestamp, bullet_id)),
      se AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY event_timestamp, bullet_id ROWS UNBOUNDED PRECEDING) AS session FROM br) SELECT user_id, bullet_id, event_timestamp, first_play, next_ts FROM se WHERE session = 0""",
    "address_stats": f"""{_B}, li AS (SELECT ip, currency_type, user_id, epoch_us(min(event_timestamp)) / 1e6 AS f, epoch_us(max(event_timestamp)) / 1e6 AS l FROM bullets GROUP BY ALL), co AS (SELECT ip, currency_type, max(u) AS max_user_concurrency FROM (SELECT ip, currency_type, floor(f / 10) AS b, count(*) AS u FROM li GROUP BY ALL) GROUP BY ALL),
      ho AS (SELECT ip, currency_type, {_R("avg((l - f) / 3600)", "avg_hours", 3)}, {_R("stddev_samp((l - f) / 3600)", "std_hours", 3)} FROM li GROUP BY ALL), ga AS (SELECT ip, currency_type, user_id, (epoch_us(event_timestamp) - lag(epoch_us(event_timestamp)) OVER (PARTITION BY ip, user_id, currency_type ORDER BY event_timestamp, bullet_id)) / 1e6 AS gap FROM bullets),
      ug AS (SELECT ip, currency_type, user_id, avg(gap) AS m, coalesce(stddev_samp(gap), 0) AS s FROM ga WHERE gap > 0 AND gap < 86400 GROUP BY ALL),
      ig AS (SELECT ip, currency_type, {_R("avg(m)", "mean_gap_mean", 3)}, {_R("CASE WHEN count(*) <= 1 THEN 0 ELSE stddev_samp(m) END", "mean_gap_std", 3)}, {_R("avg(s)", "std_gap_mean", 3)}, {_R("CASE WHEN count(*) <= 1 THEN 0 ELSE stddev_samp(s) END", "std_gap_std", 3)} FROM ug GROUP BY ALL),
      al AS (SELECT ip, currency_type, count(DISTINCT user_id) AS num_user_id, {_R("sum(payout) / nullif(sum(bet), 0)", "rtp", 3)}, {_R("sum(payout - bet)", "total_profit", 3)}, {_R("min(bet)", "min_bet", 3)}, {_R("max(bet)", "max_bet", 3)}, count(bet) AS num_bets, count(DISTINCT bet) AS num_unique_bets, count(DISTINCT fish_value) AS num_unique_fish_value FROM bullets GROUP BY ALL)
      SELECT * FROM al JOIN ho USING (ip, currency_type) LEFT JOIN co USING (ip, currency_type) LEFT JOIN ig USING (ip, currency_type)""",
    "cluster_stats": f"""WITH r AS (SELECT user_id % 4 AS cluster, user_id, ts, CASE WHEN event_id % 9 <> 0 THEN value - 20 END AS x, CAST(json_extract_string(props, '$.k') AS BIGINT) AS amount FROM events),
      m AS (SELECT cluster, avg(x) AS mu, stddev_pop(x) AS sd FROM r GROUP BY cluster), k AS (SELECT cluster, avg(pow((x - mu) / nullif(sd, 0), 3)) AS skewness FROM r JOIN m USING (cluster) GROUP BY cluster),
      a AS (SELECT cluster, count(*) AS amounts, max(n) AS top_count FROM (SELECT cluster, amount, count(*) AS n FROM r GROUP BY ALL) GROUP BY cluster), f AS (SELECT cluster, avg(v) AS first_mean, count(*) AS users FROM (SELECT cluster, user_id, arg_min(amount, ts) AS v FROM r GROUP BY ALL) GROUP BY cluster)
      SELECT cluster, {_R("avg(x)", "mean")}, {_R("min(x)", "low")}, {_R("max(x)", "high")}, {", ".join(_R(f"quantile_cont(x, {q})", n) for n, q in (("p5", 0.05), ("p25", 0.25), ("median", 0.5), ("p75", 0.75), ("p95", 0.95)))}, {_R("any_value(skewness)", "skewness")}, {_R("stddev_samp(x)", "std")}, {_R("stddev_pop(x)", "scaler_std")},
        count(*) AS n, count(*) - count(x) AS nan_count, {_R("(count(*) - count(x)) / count(*)", "nan_ratio")}, count(*) FILTER (x < 0) AS negative_count, {_R("count(*) FILTER (x < 0) / count(*)", "negative_ratio")}, any_value(amounts) AS amounts, any_value(top_count) AS top_count, {_R("any_value(first_mean)", "first_mean")}, any_value(users) AS users
      FROM r JOIN k USING (cluster) JOIN a USING (cluster) JOIN f USING (cluster) GROUP BY cluster""",
    "room_day_means": f"{_B} SELECT CAST(event_timestamp AS DATE) AS day, room_id, {_R('avg(bet)', 'bet')}, {_R('avg(payout)', 'payout')} FROM bullets GROUP BY ALL",
    "user_times": f"""WITH g AS (SELECT user_id, epoch_us(ts) / 1e6 AS a, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts)) / 1e6 AS gap FROM events)
      SELECT user_id, {_R("(max(a) - min(a)) / 3600", "hours", 2)}, {_R("avg(gap) FILTER (gap <= 43200)", "gap_mean", 2)}, {_R("median(gap) FILTER (gap <= 43200)", "gap_median", 2)}, count(*) FILTER (gap > 43200) + 1 AS sessions FROM g GROUP BY user_id""",
    "change_across": f"""WITH c AS (SELECT CAST(ts AS DATE) AS day, avg(value) FILTER (event_type = 'view') AS a, avg(value) FILTER (event_type = 'click') AS b, median(value) FILTER (event_type = 'view') AS m, median(value) FILTER (event_type = 'click') AS n FROM events GROUP BY ALL)
      SELECT day, {_R("a", "mean_base")}, {_R("b", "mean_other")}, {_R("m", "median_base")}, {_R("n", "median_other")}, {_R("100 * (b - a) / nullif(abs(a), 0)", "mean_change")}, {_R("100 * (n - m) / nullif(abs(m), 0)", "median_change")} FROM c""",
    "seasons": " UNION ALL ".join(f"SELECT '{k}' AS season, CAST({e} AS INTEGER) AS period, {_R('avg(value)', 'mean')}, count(value) AS n FROM events GROUP BY 1, 2" for k, e in (("month", "month(ts)"), ("weekday", "isodow(ts) - 1"), ("day", "day(ts)"), ("hour", "hour(ts)"))),
    "sign_split": f"""WITH e AS (SELECT event_type, CASE WHEN event_id % 6 = 0 THEN 0.0 ELSE value - 25 END AS x FROM events) SELECT event_type, count(x) AS n, count(*) FILTER (x > 0) AS positive, count(*) FILTER (x = 0) AS zero, count(*) FILTER (x < 0) AS negative, {_R("avg(x)", "mean")},
      {_R("100 * count(*) FILTER (x > 0) / count(x)", "positive_pct")}, {_R("100 * count(*) FILTER (x = 0) / count(x)", "zero_pct")}, {_R("100 * count(*) FILTER (x < 0) / count(x)", "negative_pct")} FROM e GROUP BY event_type""",
    "distinct_numbers": "WITH c AS (SELECT concat_ws(', ', CAST(p_partkey % 97 AS VARCHAR), 'x', CAST(p_size * 3 AS VARCHAR)) AS a, CASE WHEN p_partkey % 2 = 0 THEN '-1,' || p_size END AS b FROM part), p AS (SELECT trim(unnest(string_split(a, ','))) AS c FROM c UNION ALL SELECT trim(unnest(string_split(b, ','))) FROM c) SELECT DISTINCT CAST(c AS BIGINT) AS number FROM p WHERE regexp_full_match(c, '[0-9]+')",
    "stored_z_scores": f"SELECT l_orderkey, l_linenumber, {_R('(l_quantity - 25) / 14', 'l_quantity')}, {_R('l_discount', 'l_discount')}, {_R('(l_tax - 0.04::DOUBLE) / 0.026::DOUBLE', 'l_tax')} FROM lineitem",
    "approximate_percentiles": "SELECT l_returnflag, quantile_disc(l_quantity, 0.25) AS p25, quantile_disc(l_quantity, 0.5) AS median, quantile_disc(l_quantity, 0.75) AS p75 FROM lineitem GROUP BY ALL",
    "range_means": f"""{_STATS}, al AS (SELECT * FROM s WHERE ai_group = 'All'), hi AS (SELECT max(activity_date) AS h, min(activity_date) AS l FROM al), rg AS (SELECT al.*, CASE WHEN activity_date > h - 10 THEN 3 WHEN activity_date > h - 20 THEN 2 WHEN activity_date > h - 30 THEN 1 END AS "range" FROM al, hi),
      {_boot('(SELECT * FROM rg WHERE "range" IS NOT NULL)', '"range"', "user_total_bet", "activity_date || '|' || user_id")} SELECT "range", n, {", ".join(_R(c, c, 5) for c in ("mean", "median", "low", "high", "lower", "upper"))} FROM bt""",
    "extended_metrics": f"""{_STATS} SELECT activity_date, ai_group, {_R("avg(user_num_bets)", "user_num_bets", 9)}, {_R("avg(user_total_bet)", "user_total_bet", 9)}, min(user_group) AS user_group, {_R("sum(user_total_payout) / nullif(sum(user_total_bet), 0)", "rtp", 9)}, count(DISTINCT user_id) FILTER (user_group = 'new') AS num_new_users FROM s GROUP BY ALL""",
    "plot_values": f"""{_STATS}, ch AS (SELECT * FROM s WHERE ai_group = 'AI'), {_boot("ch", "activity_date", "user_num_bets", "activity_date || '|' || ai_group || '|' || user_id")} SELECT activity_date, {_R("mean", "y", 5)}, {_R("lower", "lower", 5)}, {_R("upper", "upper", 5)} FROM bt""",
    "downsample": f"{_S}, r AS (SELECT user_id, spin_id, payout, row_number() OVER (PARTITION BY user_id ORDER BY spin_id) - 1 AS place, ceil(count(*) OVER (PARTITION BY user_id) / 10) AS step FROM bets) SELECT user_id, spin_id, {_R('payout', 'payout')} FROM r WHERE place % step = 0",
    "control_sample": "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY c_custkey ORDER BY md5('7|' || c_custkey), c_custkey LIMIT 20",
    "users_by_profit": f"{_S} SELECT user_id, {_R('sum(payout - bet_amount)', 'profit')} FROM bets GROUP BY user_id ORDER BY profit DESC, user_id",
    "year_report": f"""WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, {", ".join(f"sum(o_totalprice) FILTER (o_orderpriority = '{p}') AS {n}_o_totalprice, CAST(sum(1) FILTER (o_orderpriority = '{p}') AS BIGINT) AS {n}_orders" for p, n in _PRIORITIES.items())} FROM orders GROUP BY ALL),
      b AS (SELECT CAST(day + INTERVAL 1 YEAR AS DATE) AS day, {", ".join(f"{n}_{v} AS {n}_{v}_before" for n in _PRIORITIES.values() for v in ("o_totalprice", "orders"))} FROM o)
      SELECT day, {", ".join(f"{_R(f'{n}_o_totalprice', f'{n}_o_totalprice', 4)}, {n}_orders, {_R(f'{n}_o_totalprice_before', f'{n}_o_totalprice_before', 4)}, {n}_orders_before" for n in _PRIORITIES.values())} FROM o LEFT JOIN b USING (day) WHERE day < (SELECT max(day) FROM o)""",
    "period_columns": f"{_S} SELECT spin_id, CAST(created_at AS DATE) AS day, CAST(date_trunc('week', created_at) AS DATE) AS week, CAST(date_trunc('month', created_at) AS DATE) AS month FROM bets",
}
