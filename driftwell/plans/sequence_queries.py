"""Queries of windows over users' rows, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.functions.columns import rounded
from driftwell.operators import sequences as S
from driftwell.sources.tables import BETS_SQL, BULLETS_SQL, bets, bullets, load

GAP = 43_200


def _bets(build):
    return lambda spark, d: rounded(build(bets(load(spark, d, "events"))))


def _events(build):
    return lambda spark, d: rounded(build(load(spark, d, "events")))


def _share(e):
    return S.share_of_group(e.withColumn("day", F.to_date("ts")), ["day", "event_type"], ["day"])


def _near(e):
    return e.select("event_id", *(S.near_events(e, "user_id", "ts", GAP, side).alias(f"near_{side}") for side in ("before", "after", "both")), *(S.near_events(e, "user_id", "ts", GAP, side, far=True).alias(f"far_{side}") for side in ("before", "after", "both")))


def _lags(b):
    order = ("created_at", "spin_id")
    return b.select("spin_id", S.previous("payout", "user_id", *order).alias("previous_payout"), S.previous("payout", "user_id", *order, default=0.0).alias("previous_or_zero"), S.delta("bet_amount", "user_id", *order).alias("delta_bet"))


def _final_order(b):
    return b.select("user_id", "ai_group", "spin_id", "payout").orderBy("user_id", "ai_group", "spin_id")


def _legacy(b):
    """Times are rounded coarser: their means end in halves of the sixth place."""
    out = S.legacy_grouped(S.legacy_enriched(b, 20_000, 172_800, 10))
    return out.withColumns({c: F.round(c, 2) for c in out.columns if c.startswith(("delta_t_", "avg_time"))})


QUERIES = {
    "user_bet_count": _bets(lambda b: S.user_counts(b).select("spin_id", "user_bet_count", "mathtable_change")),
    "window_over_aggregate": _events(_share),
    "lag_over_grouped": lambda spark, d: S.last_active_day(bullets(load(spark, d, "events"))),
    "free_rounds_per_base": _bets(lambda b: S.free_rounds_per_base(b).select("spin_id", "base_group", "free_rounds")),
    "block_totals": _bets(lambda b: S.block_totals(b.withColumn("hour", F.date_trunc("hour", "created_at")), ["table_id", "hour"], "payout", "overall_payout").select("spin_id", "overall_payout")),
    "group_extremes": _bets(lambda b: S.group_extremes(b, ["user_id", "table_id"], "payout").select("spin_id", "payout_max", "payout_sum", "group_size")),
    "near_events": _events(_near),
    "lag_helpers": _bets(_lags),
    "free_spin_fold": _bets(S.fold_free_spins),
    "context_columns": _bets(lambda b: S.context_columns(b).select("spin_id", "last_bet", "last_payout", "profit_sofar")),
    "legacy_enriched": _bets(lambda b: S.legacy_enriched(b, 20_000, 172_800, 10)),
    "legacy_grouped": _bets(_legacy),
    "final_order": _bets(_final_order),
}

_R = lambda e, n, p=6: f"round(CAST({e} AS DOUBLE), {p}) + 0.0 AS {n}"
_B = f"WITH {BETS_SQL}"
_RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_BASE = f"{_B}, g AS (SELECT *, CAST(sum(CASE WHEN bet_type = 'BASE' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY spin_id, created_at {_RUN}) AS BIGINT) AS base_group FROM bets)"
_E = "epoch_us(created_at) / 1e6"
_LEGACY = f"""{_B}, a AS (SELECT *, payout - bet_amount AS profit, coalesce({_E} - lag({_E}) OVER w, 0) AS delta_t, bet_amount - coalesce(lag(bet_amount) OVER w, 0) AS delta_bet,
  payout - bet_amount - coalesce(lag(payout - bet_amount) OVER w, 0) AS delta_profit, coalesce(balance_after_bet - lag(balance_after_payout) OVER w, 0) AS moved, sign(payout - bet_amount) AS s, lag(sign(payout - bet_amount)) OVER w AS ps,
  CASE WHEN hour(created_at) < 6 THEN 'midnight' WHEN hour(created_at) < 12 THEN 'morning' WHEN hour(created_at) < 18 THEN 'afternoon' ELSE 'night' END AS part FROM bets WINDOW w AS (PARTITION BY user_id ORDER BY created_at, spin_id)),
b AS (SELECT *, sum(CASE WHEN delta_t > 20000 THEN 1 ELSE 0 END) OVER w AS run, sum(CASE WHEN delta_t > 20000 OR ps IS NULL OR ps <> s THEN 1 ELSE 0 END) OVER w AS srun, CAST(sum(CASE WHEN delta_t > 172800 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS group_index FROM a
  WINDOW w AS (PARTITION BY user_id ORDER BY created_at, spin_id {_RUN})),
c AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id, run ORDER BY created_at, spin_id) - 1 AS INTEGER) AS streak, CAST(row_number() OVER (PARTITION BY user_id, srun ORDER BY created_at, spin_id) - 1 AS INTEGER) AS ss,
  CAST((row_number() OVER (PARTITION BY user_id, group_index ORDER BY created_at, spin_id) - 1) // 10 AS BIGINT) AS sub_index FROM b),
l AS (SELECT * EXCLUDE (moved, s, ps, run, srun, ss), CASE WHEN s > 0 THEN ss ELSE 0 END AS win_streak, CASE WHEN s < 0 THEN ss ELSE 0 END AS lose_streak, greatest(moved, 0.0) AS deposit, greatest(-moved, 0.0) AS withdrawal FROM c)"""
_DOUBLES = ("bet_amount", "payout", "balance_after_bet", "balance_after_payout", "profit", "delta_t", "delta_bet", "delta_profit", "deposit", "withdrawal")


def _legacy_grouped() -> str:
    cols = ["user_id", "group_index", "sub_index", "count(*) AS group_num", _R("avg(CASE WHEN bet_amount <> 0 THEN payout / bet_amount ELSE 0 END)", "rtp_mean")]
    for c, n in S.LEGACY.items():
        places = 2 if n == "delta_t" else 6
        cols += [_R(f"avg({c})", f"{n}_mean", places), _R(f"coalesce(stddev_samp({c}), 0)", f"{n}_std", places), *(_R(f"{f}({c})", f"{n}_{f}", places) for f in ("min", "max", "sum"))]
    span = "(epoch_us(max(created_at)) - epoch_us(min(created_at))) / 1e6"
    cols += ["count(*) FILTER (bet_type = 'FREE') AS free_count", _R("count(*) FILTER (payout > 0) / count(*)", "payout_rate"), _R("count(*) FILTER (profit > 0) / count(*)", "profit_rate"), "min(created_at) AS start_time", "max(created_at) AS end_time"]
    cols += [f"count(*) FILTER (part = '{p}') AS {p}_count" for p in ("morning", "afternoon", "night", "midnight")]
    cols += ["count(*) FILTER (dayofweek(created_at) IN (0, 6)) AS weekend_count", _R(span, "duration_seconds"), f"round({span} / count(*), 2) + 0.0 AS avg_time_per_bet"]
    mode = "SELECT user_id, group_index, sub_index, table_id AS table_mode FROM l GROUP BY user_id, group_index, sub_index, table_id QUALIFY row_number() OVER (PARTITION BY user_id, group_index, sub_index ORDER BY count(*) DESC, table_id) = 1"
    return f"{_LEGACY}, g AS (SELECT {', '.join(cols)} FROM l GROUP BY user_id, group_index, sub_index), m AS ({mode}) SELECT g.*, m.table_mode FROM g JOIN m USING (user_id, group_index, sub_index)"


_AT = "epoch_us(ts)"
_NEAR = f"{_AT} - lag({_AT}) OVER w", f"lead({_AT}) OVER w - {_AT}"
SQL = {
    "user_bet_count": f"{_B} SELECT spin_id, count(*) OVER (PARTITION BY user_id) AS user_bet_count, CASE WHEN lag(table_id) OVER (PARTITION BY user_id ORDER BY created_at, spin_id) <> table_id THEN 1 ELSE 0 END AS mathtable_change FROM bets",
    "window_over_aggregate": f"SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, {_R('count(*) / sum(count(*)) OVER (PARTITION BY CAST(ts AS DATE))', 'share')} FROM events GROUP BY 1, 2",
    "lag_over_grouped": f"WITH {BULLETS_SQL}, d AS (SELECT user_id, CAST(event_timestamp AS DATE) AS day, count(*) AS bullets FROM bullets GROUP BY ALL) SELECT *, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS day_last_bet FROM d",
    "free_rounds_per_base": f"{_BASE}, f AS (SELECT *, count(*) FILTER (bet_type = 'FREE') OVER (PARTITION BY user_id, base_group) AS free_rounds FROM g) SELECT spin_id, base_group, free_rounds FROM f WHERE bet_type = 'BASE'",
    "block_totals": f"{_B} SELECT spin_id, {_R('sum(payout) OVER (PARTITION BY table_id, date_trunc(\'hour\', created_at))', 'overall_payout')} FROM bets",
    "group_extremes": f"{_B} SELECT spin_id, {_R('max(payout) OVER w', 'payout_max')}, {_R('sum(payout) OVER w', 'payout_sum')}, count(*) OVER w AS group_size FROM bets WINDOW w AS (PARTITION BY user_id, table_id)",
    "near_events": f"""WITH g AS (SELECT event_id, {_NEAR[0]} AS b, {_NEAR[1]} AS a FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) SELECT event_id, coalesce(b <= {GAP}000000, false) AS near_before, coalesce(a <= {GAP}000000, false) AS near_after,
      coalesce(b <= {GAP}000000, false) OR coalesce(a <= {GAP}000000, false) AS near_both, coalesce(b > {GAP}000000, false) AS far_before, coalesce(a > {GAP}000000, false) AS far_after, coalesce(b > {GAP}000000, false) OR coalesce(a > {GAP}000000, false) AS far_both FROM g""",
    "lag_helpers": f"{_B} SELECT spin_id, {_R('lag(payout) OVER w', 'previous_payout')}, {_R('coalesce(lag(payout) OVER w, 0)', 'previous_or_zero')}, {_R('bet_amount - lag(bet_amount) OVER w', 'delta_bet')} FROM bets WINDOW w AS (PARTITION BY user_id ORDER BY created_at, spin_id)",
    "free_spin_fold": f"""{_BASE} SELECT user_id, base_group, max(spin_id) FILTER (bet_type = 'BASE') AS spin_id, max(created_at) FILTER (bet_type = 'BASE') AS created_at, {_R("max(bet_amount) FILTER (bet_type = 'BASE')", "bet_amount")}, {_R("sum(payout)", "payout")}, count(*) FILTER (bet_type = 'FREE') AS free_spins FROM g WHERE base_group > 0 GROUP BY ALL""",
    "context_columns": f"""{_B} SELECT spin_id, {_R("coalesce(lag(bet_amount) OVER w, 0)", "last_bet")}, {_R("coalesce(lag(payout) OVER w, 0)", "last_payout")},
      {_R("coalesce(sum(payout - bet_amount) OVER (PARTITION BY user_id ORDER BY spin_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)", "profit_sofar")} FROM bets WINDOW w AS (PARTITION BY user_id ORDER BY spin_id)""",
    "legacy_enriched": f"{_LEGACY} SELECT * REPLACE ({', '.join(_R(c, c) for c in _DOUBLES)}) FROM l",
    "legacy_grouped": _legacy_grouped(),
    "final_order": f"{_B} SELECT user_id, ai_group, spin_id, {_R('payout', 'payout')} FROM bets ORDER BY user_id, ai_group, spin_id",
}
