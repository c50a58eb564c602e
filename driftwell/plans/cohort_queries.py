"""Queries of user statistics, cohort metrics and retention, and their SQL."""

from __future__ import annotations

from driftwell.functions.columns import rounded
from driftwell.operators import metrics as M
from driftwell.operators import userstats as U
from driftwell.sources.tables import BETS_SQL, BULLETS_SQL, bets, bullets, load

GAP = 21_600


def _bets(build):
    return lambda spark, sf_dir: rounded(build(bets(load(spark, sf_dir, "events"))))


def _bullets(build):
    return lambda spark, sf_dir: rounded(build(bullets(load(spark, sf_dir, "events"))))


def _slots(grain: str) -> str:
    r = lambda e: f"round({e}, 6) + 0.0"
    base, free, hit = "bet_type = 'BASE'", "bet_type = 'FREE'", "payout > 0"
    sums = {
        "user_total_bet": "coalesce(sum(bet), 0.0)",
        "user_total_bet_bg": f"sum(CASE WHEN {base} THEN bet ELSE 0.0 END)",
        "user_total_bet_fg": f"sum(CASE WHEN {free} THEN bet_amount ELSE 0.0 END)",
        "user_avg_bet_amount": "avg(bet)",
        "user_total_payout": "sum(payout)",
        "user_total_payout_bg": f"sum(CASE WHEN {base} THEN payout ELSE 0.0 END)",
        "user_total_payout_fg": f"sum(CASE WHEN {free} THEN payout ELSE 0.0 END)",
        "pos_delta_bet": "sum(CASE WHEN delta_bet > 0 THEN delta_bet ELSE 0.0 END)",
        "neg_delta_bet": "sum(CASE WHEN delta_bet < 0 THEN delta_bet ELSE 0.0 END)",
        "user_rtp": "sum(payout) / nullif(sum(bet), 0)",
    }
    counts = {"user_num_bets": "true", "user_num_bets_bg": base, "user_num_bets_fg": free, "user_num_bets_with_payout": hit, "user_num_bets_bg_with_payout": f"{hit} AND {base}", "user_num_bets_fg_with_payout": f"{hit} AND {free}"}
    return f"""{BETS_SQL},
b AS (SELECT *, CASE WHEN {base} THEN bet_amount END AS bet, CAST(date_trunc('{grain}', created_at) AS DATE) AS activity_date,
  CASE WHEN lag(table_id) OVER w <> table_id THEN 1 ELSE 0 END AS table_change,
  CASE WHEN {base} THEN bet_amount END - lag(CASE WHEN {base} THEN bet_amount END) OVER w AS delta_bet,
  CAST(min(created_at) OVER (PARTITION BY user_id) AS DATE) AS first_date FROM bets WINDOW w AS (PARTITION BY user_id ORDER BY spin_id, created_at)),
f AS (SELECT * REPLACE (unnest([ai_group, 'All']) AS ai_group) FROM b),
u AS (SELECT activity_date, ai_group, user_id, min(first_date) AS first_date, {", ".join(f"count(*) FILTER ({c}) AS {n}" for n, c in counts.items())}, {", ".join(f"{e} AS {n}" for n, e in sums.items())},
  CAST(sum(table_change) AS BIGINT) AS table_changes FROM f GROUP BY activity_date, ai_group, user_id),
s AS (SELECT *, CASE WHEN date_diff('day', first_date, activity_date) <= 3 THEN 'new' WHEN date_diff('day', first_date, activity_date) <= 7 THEN 'beginner' ELSE 'old' END AS user_group FROM u)""" + "|" + ", ".join(f"{r(n)} AS {n}" for n in sums)


def _slots_sql(grain: str) -> str:
    ctes, _, rnd = _slots(grain).rpartition("|")
    return f"WITH {ctes}\nSELECT * REPLACE ({rnd}) FROM s"


_SUM = {f"total_{x}": f"sum(user_{x})" for x in ("num_bets", "num_bets_bg", "num_bets_fg", "num_bets_with_payout", "num_bets_bg_with_payout", "num_bets_fg_with_payout")}
_SUM = {k: f"CAST({v} AS BIGINT)" for k, v in _SUM.items()} | {f"total_{x}": f"sum(user_total_{x})" for x in ("bet", "bet_bg", "bet_fg", "payout", "payout_bg", "payout_fg")}
_U, _BET, _PAY, _N = "count(DISTINCT user_id)", "nullif(sum(user_total_bet), 0)", "sum(user_total_payout)", "nullif(sum(user_num_bets), 0)"
_MED = "median(CASE WHEN user_total_bet > 0 THEN user_total_payout / user_total_bet END)"
_METRIC_SQL = _SUM | {
    "num_active_users": "count(DISTINCT CASE WHEN user_num_bets >= 5 THEN user_id END)",
    "num_new_users": "count(DISTINCT CASE WHEN user_group = 'new' THEN user_id END)",
    "day0_num_users": _U,
    "total_num_bets_per_user": f"sum(user_num_bets) / {_U}",
    "total_bet_per_user": f"sum(user_total_bet) / {_U}",
    "total_profit": f"{_PAY} - sum(user_total_bet)",
    "total_profit_per_user": f"({_PAY} - sum(user_total_bet)) / {_U}",
    "rtp": f"{_PAY} / {_BET}",
    "rtp_bg": f"sum(user_total_payout_bg) / {_BET}",
    "rtp_fg": "sum(user_total_payout_fg) / nullif(sum(user_total_bet_fg), 0)",
    "fg_ratio": f"sum(user_num_bets_fg) / {_N}",
    "hit_rate": f"sum(user_num_bets_with_payout) / {_N}",
    "hit_rate_bg": "sum(user_num_bets_bg_with_payout) / nullif(sum(user_num_bets_bg), 0)",
    "hit_rate_fg": "sum(user_num_bets_fg_with_payout) / nullif(sum(user_num_bets_fg), 0)",
    "active_user_no_fg_ratio": f"count(*) FILTER (user_num_bets_fg = 0) / {_U}",
    "num_active_user_0_rtp": "count(*) FILTER (user_total_payout = 0)",
    "active_user_0_rtp_ratio": f"count(*) FILTER (user_total_payout = 0) / {_U}",
    **{f"active_user_rtp_less_0_{t}_ratio": f"count(*) FILTER (user_total_bet > 0 AND user_rtp < 0.{t}::DOUBLE) / {_U}" for t in range(1, 6)},
    "user_rtp_median": _MED,
    "user_rtp_ultilization_ratio": f"{_MED} / nullif({_PAY} / {_BET}, 0)",
}


def _metrics_sql() -> str:
    ctes = _slots("day").rpartition("|")[0]
    whole = {n for n, e in _METRIC_SQL.items() if e.startswith(("CAST", "count(DISTINCT")) or n == "num_active_user_0_rtp"}
    cols = ", ".join(f"{e} AS {n}" if n in whole else f"round(CAST({e} AS DOUBLE), 9) + 0.0 AS {n}" for n, e in _METRIC_SQL.items())
    return f"WITH {ctes}\nSELECT activity_date, ai_group, {cols} FROM s GROUP BY activity_date, ai_group"


def _metrics(spark, sf_dir):
    rows = U.slot_user_stats(bets(load(spark, sf_dir, "events")), "day")
    return rounded(M.metrics(rows, ["activity_date", "ai_group"], active=5), 9)


def _retention(grain):
    def query(spark, sf_dir):
        rows = U.slot_user_stats(bets(load(spark, sf_dir, "events")), "day")
        return rounded(M.retention(rows, ["ai_group"], "activity_date", grain))

    return query


def _retention_sql(grain: str) -> str:
    days = M.HORIZONS[grain]
    joins = "\n".join(f"LEFT JOIN p p{i} ON p{i}.ai_group = p.ai_group AND p{i}.user_id = p.user_id AND p{i}.activity_date = p.activity_date + {d}" for i, d in enumerate(days, 1))
    return f"""WITH {_slots("day").rpartition("|")[0]}, p AS (SELECT DISTINCT ai_group, activity_date, user_id FROM s)
SELECT p.ai_group, p.activity_date, count(*) AS day0_num_users, {", ".join(f"count(p{i}.user_id) AS day{i}_num_users" for i in (1, 2, 3))},
{", ".join(f"round(count(p{i}.user_id) / count(*), 6) + 0.0 AS retention_rate_day{i}" for i in (1, 3))} FROM p {joins} GROUP BY p.ai_group, p.activity_date"""


def _backward(spark, sf_dir):
    from pyspark.sql import functions as F

    days = bullets(load(spark, sf_dir, "events")).select("user_id", F.to_date("event_timestamp").alias("day")).distinct()
    out = days
    for k in (1, 3):
        out = out.join(days.select("user_id", F.date_add("day", k).alias("day"), F.lit(1).alias(f"was{k}")), ["user_id", "day"], "left")
    return out.groupBy("day").agg(F.count("*").alias("users"), F.count("was1").alias("active_1_before"), F.count("was3").alias("active_3_before"))


def _quality(spark, sf_dir):
    rows = U.slot_user_stats(bets(load(spark, sf_dir, "events")), "day")
    return M.quality(rows, ["user_id", "user_num_bets", "user_avg_bet_amount", "user_rtp", "user_group"])


_B = f"WITH {BULLETS_SQL}"
_SESSION = f"""{_B}, d AS (SELECT *, CAST(event_timestamp AS DATE) AS day FROM bullets),
g AS (SELECT *, CASE WHEN date_diff('second', lag(event_timestamp) OVER w, event_timestamp) >= {GAP} THEN 1 ELSE 0 END AS brk FROM d WINDOW w AS (PARTITION BY user_id, day ORDER BY event_timestamp, bullet_id)),
h AS (SELECT * EXCLUDE brk, CAST(sum(brk) OVER (PARTITION BY user_id, day ORDER BY event_timestamp, bullet_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM g),
s AS (SELECT *, CAST(row_number() OVER w AS INTEGER) AS bet_index, round(sum(payout) OVER w / nullif(sum(bet) OVER w, 0), 6) + 0.0 AS cumulative_rtp, CAST(sum(killed) OVER w AS BIGINT) AS killed_sofar,
  date_diff('second', min(event_timestamp) OVER (PARTITION BY user_id, day, session), event_timestamp) AS session_seconds FROM h
  WINDOW w AS (PARTITION BY user_id, day, session ORDER BY event_timestamp, bullet_id ROWS UNBOUNDED PRECEDING))"""

QUERIES = {
    **{f"slot_user_stats_{g}": _bets(lambda b, g=g: U.slot_user_stats(b, g)) for g in ("day", "week", "month")},
    **{f"shooter_user_stats_{g}": _bullets(lambda b, g=g: U.shooter_user_stats(b, g)) for g in ("day", "week", "month")},
    "metric_catalogue": _metrics,
    "metric_quality": _quality,
    **{f"retention_horizon_{g}": _retention(g) for g in ("day", "week")},
    "retention_exact_backward": _backward,
    "retention_hour_window": _bullets(U.hour_retention),
    "retention_next_visit": _bullets(U.next_visit),
    "kill_streaks": _bullets(lambda b: U.kill_streaks(b, GAP)),
    "day_sessions": _bullets(lambda b: U.day_sessions(b, GAP)),
    "bet_index_curve": lambda spark, sf_dir: rounded(U.bet_index_curve(rounded(U.day_sessions(bullets(load(spark, sf_dir, "events")), GAP)), 1, 200), 11),
    "ip_stats": _bullets(U.ip_stats),
    "ftue_milestones": _bullets(U.milestones),
    "bets_before_first_free": _bets(U.before_first_free),
    "remaining_bets": _bets(U.left_after_last),
}
_KILL = f"""{_B}, k AS (SELECT *, CASE WHEN date_diff('second', lag(event_timestamp) OVER w, event_timestamp) <= {GAP} THEN 0 ELSE 1 END AS brk FROM bullets WHERE killed = 1 WINDOW w AS (PARTITION BY user_id ORDER BY event_timestamp, bullet_id)),
i AS (SELECT *, CAST(sum(brk) OVER (PARTITION BY user_id ORDER BY event_timestamp, bullet_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM k)
SELECT user_id, island, count(*) AS length, min(event_timestamp) AS begins, max(event_timestamp) AS ends FROM i GROUP BY user_id, island"""


def _shooter_sql(grain: str) -> str:
    bands = {"low": "fish_value <= 10", "medium": "fish_value > 10 AND fish_value <= 130", "high": "fish_value > 130 AND fish_value <= 200", "ultra": "fish_value > 200"}
    return f"""{_B} SELECT CAST(date_trunc('{grain}', event_timestamp) AS DATE) AS activity_date, user_id, coalesce(max(CASE WHEN strategy_name = 'AI' THEN 'AI' END), min(strategy_name)) AS daily_group,
  count(*) AS num_bullets, round(sum(bet), 6) + 0.0 AS total_bet, round(sum(payout), 6) + 0.0 AS total_payout, CAST(sum(killed) AS BIGINT) AS kills, count(DISTINCT room_id) AS rooms,
  round(stddev_samp(payout - bet) / nullif(abs(avg(payout - bet)), 0), 6) + 0.0 AS profit_cv, {", ".join(f"count(*) FILTER ({c}) AS bullets_{n}" for n, c in bands.items())}
  FROM bullets GROUP BY ALL HAVING max(killed) > 0"""


SQL = {
    **{f"slot_user_stats_{g}": _slots_sql(g) for g in ("day", "week", "month")},
    **{f"shooter_user_stats_{g}": _shooter_sql(g) for g in ("day", "week", "month")},
    "metric_catalogue": _metrics_sql(),
    "metric_quality": f"WITH {_slots('day').rpartition('|')[0]} SELECT " + ", ".join(f"count(*) - count({c}) AS {c}" for c in ("user_id", "user_num_bets", "user_avg_bet_amount", "user_rtp", "user_group")) + " FROM s",
    **{f"retention_horizon_{g}": _retention_sql(g) for g in ("day", "week")},
    "retention_exact_backward": f"{_B}, d AS (SELECT DISTINCT user_id, CAST(event_timestamp AS DATE) AS day FROM bullets) SELECT d.day, count(*) AS users, count(a.user_id) AS active_1_before, count(c.user_id) AS active_3_before FROM d LEFT JOIN d a ON a.user_id = d.user_id AND a.day = d.day - 1 LEFT JOIN d c ON c.user_id = d.user_id AND c.day = d.day - 3 GROUP BY d.day",
    "retention_hour_window": f"""{_B}, d AS (SELECT user_id, CAST(event_timestamp AS DATE) AS day, min(event_timestamp) AS f, max(event_timestamp) AS l FROM bullets GROUP BY ALL)
SELECT day, count(*) AS users, CAST(sum(d1) AS BIGINT) AS day1, CAST(sum(d3) AS BIGINT) AS day3 FROM (SELECT a.user_id, a.day, max(CASE WHEN b.l >= a.f + INTERVAL 24 HOUR AND b.f < a.f + INTERVAL 48 HOUR THEN 1 ELSE 0 END) AS d1,
  max(CASE WHEN b.l >= a.f + INTERVAL 72 HOUR AND b.f < a.f + INTERVAL 96 HOUR THEN 1 ELSE 0 END) AS d3 FROM d a JOIN d b USING (user_id) GROUP BY a.user_id, a.day) GROUP BY day""",
    "retention_next_visit": f"{_B}, d AS (SELECT DISTINCT user_id, CAST(event_timestamp AS DATE) AS day FROM bullets), n AS (SELECT *, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS nx FROM d) SELECT day, count(*) AS users, count(nx) AS returning, round(avg(date_diff('day', day, nx)), 6) + 0.0 AS days_until FROM n GROUP BY day",
    "kill_streaks": _KILL,
    "day_sessions": f"{_SESSION} SELECT * REPLACE (round(bet, 6) + 0.0 AS bet, round(payout, 6) + 0.0 AS payout) FROM s",
    "bet_index_curve": f"{_SESSION} SELECT day, bet_index, strategy_name, count(*) AS n, round(avg(cumulative_rtp), 11) + 0.0 AS rtp_mean, round(stddev_samp(cumulative_rtp), 11) + 0.0 AS rtp_std, round(median(cumulative_rtp), 11) + 0.0 AS rtp_median FROM s WHERE bet_index BETWEEN 1 AND 200 GROUP BY ALL",
    "ip_stats": f"""{_B}, m AS (SELECT ip, max(u) AS max_users FROM (SELECT ip, epoch_us(event_timestamp) // 3600000000 AS b, count(DISTINCT user_id) AS u FROM bullets GROUP BY ALL) GROUP BY ip),
g AS (SELECT *, date_diff('second', lag(event_timestamp) OVER (PARTITION BY ip ORDER BY event_timestamp, bullet_id), event_timestamp) AS gap FROM bullets)
SELECT ip, count(DISTINCT user_id) AS users, count(*) AS n, round(avg(gap), 6) + 0.0 AS gap_mean, round(stddev_samp(gap), 6) + 0.0 AS gap_std, count(DISTINCT bet) AS bets, any_value(max_users) AS max_users FROM g JOIN m USING (ip) GROUP BY ip""",
    "ftue_milestones": f"""{_B}, r AS (SELECT *, lag(room_id) OVER w AS before, coalesce(sum(killed) OVER (PARTITION BY user_id ORDER BY event_timestamp, bullet_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS kb FROM bullets WINDOW w AS (PARTITION BY user_id ORDER BY event_timestamp, bullet_id))
SELECT user_id, min(event_timestamp) AS first_shot, min(event_timestamp) FILTER (killed = 1) AS first_kill, min(event_timestamp) FILTER (killed = 1 AND fish_value > 200) AS first_high_kill, min(event_timestamp) FILTER (before <> room_id) AS first_room_change,
  count(*) FILTER (kb = 0 AND killed = 0) AS shots_before_kill, arg_min(fish_value, event_timestamp) AS first_fish FROM r GROUP BY user_id""",
    "bets_before_first_free": f"""WITH {BETS_SQL}, r AS (SELECT *, CAST(created_at AS DATE) AS day, sum(CASE WHEN bet_type = 'FREE' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, CAST(created_at AS DATE) ORDER BY created_at, spin_id ROWS UNBOUNDED PRECEDING) AS free FROM bets)
SELECT day, user_id, ai_group, count(CASE WHEN free = 0 THEN bet_amount END) AS bets_before_free, CAST(max(free) AS BIGINT) AS free_games FROM r GROUP BY ALL""",
    "remaining_bets": f"""WITH {BETS_SQL}, r AS (SELECT *, CAST(created_at AS DATE) AS day FROM bets WHERE ai_group = 'AI'), l AS (SELECT user_id, day, table_id, max(spin_id) AS last FROM r GROUP BY ALL)
SELECT l.user_id, l.day, l.table_id, round(avg(b.bet_amount), 6) + 0.0 AS remaining_bet, count(b.bet_amount) AS remaining_bets FROM l LEFT JOIN r b ON b.user_id = l.user_id AND b.day = l.day AND b.spin_id > l.last GROUP BY l.user_id, l.day, l.table_id""",
}
