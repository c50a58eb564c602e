"""Queries of the feature pipeline, a query for each step, and their SQL."""

from __future__ import annotations

from driftwell.functions.columns import rounded
from driftwell.operators import features as P
from driftwell.operators.features import METRICS, FeatureConfig
from driftwell.sources.tables import BETS_SQL, bets, load

CFG = FeatureConfig()


def _upto(last):
    steps = (P.user_bets, P.free_game_group, P.agg_free_game, P.delta_stats, P.user_group, P.raw_stats)

    def query(spark, sf_dir):
        df = bets(load(spark, sf_dir, "events"))
        for step in steps[: steps.index(last) + 1]:
            df = df.transform(step, CFG)
        return rounded(df)

    return query


def _grouped(size: int, full: bool):
    cfg = FeatureConfig(bin_sizes=(size,), full_bins=full, partition_cols=("table_id",) if not full else ())

    def query(spark, sf_dir):
        return rounded(P.grouped(P.enriched(bets(load(spark, sf_dir, "events")), cfg), cfg, size))

    return query


def _chain(part: str = "") -> dict[str, str]:
    p = f"{part}, " if part else ""
    w = "PARTITION BY user_id ORDER BY spin_id, min_created_at"
    run = f"({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    nth = lambda by: f"CAST(row_number() OVER (PARTITION BY user_id, {by} ORDER BY spin_id, min_created_at) AS INTEGER)"
    near = f"coalesce(delta_t_seconds <= {CFG.streak_break}, false)"
    return {
        "user_bets": "SELECT * REPLACE (CASE WHEN bet_type = 'BASE' THEN bet_amount END AS bet_amount), lag(created_at) OVER (PARTITION BY user_id ORDER BY spin_id, created_at) AS prev_bet_time FROM bets",
        "free_game_group": "SELECT *, CAST(sum(CASE WHEN bet_type = 'BASE' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY spin_id, created_at ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fg_group FROM user_bets",
        "agg_free_game": f"""SELECT user_id, ai_group, {p}fg_group, min(spin_id) AS spin_id, min(created_at) AS min_created_at, max(created_at) AS max_created_at,
            count(*) FILTER (bet_type = 'FREE') AS fg_rounds, min(prev_bet_time) AS prev_bet_time, sum(bet_amount) AS bet_amount, sum(payout) AS payout,
            min(balance_after_bet) AS balance_after_bet, max(balance_after_payout) AS balance_after_payout FROM free_game_group GROUP BY user_id, ai_group, {p}fg_group""",
        "delta_stats": f"""SELECT *, date_diff('second', prev_bet_time, min_created_at) AS delta_t_seconds, bet_amount - lag(bet_amount) OVER w AS delta_bet_amount,
            payout - lag(payout) OVER w AS delta_payout, balance_after_bet + bet_amount - lag(balance_after_payout) OVER w AS balance_transaction,
            CASE WHEN payout > bet_amount THEN 1 ELSE 0 END AS is_win, CASE WHEN payout < bet_amount THEN 1 ELSE 0 END AS is_lose,
            CASE WHEN lag(payout) OVER w > lag(bet_amount) OVER w THEN 1 ELSE 0 END AS prev_win, CASE WHEN lag(payout) OVER w < lag(bet_amount) OVER w THEN 1 ELSE 0 END AS prev_lose
            FROM agg_free_game WINDOW w AS ({w})""",
        "user_group": f"""SELECT *, last_value(CASE WHEN delta_t_seconds IS NULL OR delta_t_seconds > {CFG.session_break} THEN min_created_at END IGNORE NULLS) OVER {run} AS session_start_ts,
            CAST(sum(CASE WHEN {near} THEN 0 ELSE 1 END) OVER {run} AS BIGINT) AS streak_group,
            CAST(sum(CASE WHEN {near} AND prev_win = 1 AND is_win = 1 THEN 0 ELSE 1 END) OVER {run} AS BIGINT) AS win_streak_group,
            CAST(sum(CASE WHEN {near} AND prev_lose = 1 AND is_lose = 1 THEN 0 ELSE 1 END) OVER {run} AS BIGINT) AS lose_streak_group FROM delta_stats""",
        "raw_stats": f"""SELECT *, CAST(session_start_ts AS DATE) AS session_start_date,
            CAST(dense_rank() OVER (PARTITION BY user_id, CAST(session_start_ts AS DATE) ORDER BY session_start_ts) - 1 AS INTEGER) AS session_group, CAST(min_created_at AS DATE) AS activity_date,
            CASE WHEN delta_t_seconds <= {CFG.nogap} THEN delta_t_seconds END AS delta_t_seconds_nogap, payout - bet_amount AS profit,
            CASE WHEN balance_transaction > {CFG.dead_zone} THEN balance_transaction END AS deposit, CASE WHEN balance_transaction < -{CFG.dead_zone} THEN -balance_transaction END AS withdraw,
            {nth("streak_group")} AS streak, CASE WHEN payout > bet_amount THEN {nth("win_streak_group")} END AS win_streak,
            CASE WHEN payout < bet_amount THEN {nth("lose_streak_group")} END AS lose_streak, {nth("session_start_ts")} AS session_bet_index FROM user_group""",
    }


_DOUBLES = {
    "user_bets": "bet_amount payout balance_after_bet balance_after_payout",
    "free_game_group": "bet_amount payout balance_after_bet balance_after_payout",
    "agg_free_game": "bet_amount payout balance_after_bet balance_after_payout",
    "delta_stats": "bet_amount payout balance_after_bet balance_after_payout delta_bet_amount delta_payout balance_transaction",
}
_DOUBLES["user_group"] = _DOUBLES["delta_stats"]
_DOUBLES["raw_stats"] = _DOUBLES["delta_stats"] + " profit deposit withdraw"


def _with(upto: str, part: str = "") -> str:
    out = [BETS_SQL]
    for name, sql in _chain(part).items():
        out.append(f"{name} AS ({sql})")
        if name == upto:
            break
    return "WITH " + ",\n".join(out)


def _step_sql(name: str) -> str:
    replace = ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in _DOUBLES[name].split())
    return f"{_with(name)}\nSELECT * REPLACE ({replace}) FROM {name}"


def _grouped_sql(size: int, full: bool) -> str:
    part = "" if full else "table_id"
    key = ["user_id", "ai_group", *([part] if part else []), "session_start_date", "session_group", "agg_group"]
    metrics = [*METRICS, "rtp"]
    zero = lambda m, e: f"coalesce({e}, 0.0)" if m in ("streak", "win_streak", "lose_streak") else e
    rnd = lambda e: f"round(CAST({e} AS DOUBLE), 6) + 0.0"
    div = lambda a, b: f"({a}) / nullif(CAST({b} AS DOUBLE), 0)"
    cols = [*key, "min(activity_date) AS activity_date", "min(min_created_at) AS min_created_at", "max(min_created_at) AS max_created_at", "count(user_id) AS bet_rounds", "CAST(sum(fg_rounds) AS BIGINT) AS fg_rounds"]
    for m in metrics:
        for n, e in (("avg", "avg({})"), ("std", "stddev_samp({})"), ("min", "min({})"), ("max", "max({})"), ("p25", "quantile_cont({}, 0.25)"), ("median", "quantile_cont({}, 0.5)"), ("p75", "quantile_cont({}, 0.75)")):
            cols.append(f"{rnd(zero(m, e.format(f'CAST({m} AS DOUBLE)')))} AS {m}_{n}")
    sums = {f"accum_{s}_{m}": f"sum(CASE WHEN {c} {o} 0 THEN {c} ELSE 0.0 END)" for m, c in (("delta_bet_amount", "delta_bet_amount"), ("profit", "profit")) for s, o in (("pos", ">"), ("neg", "<"))}
    sums |= {"accum_deposit": "sum(deposit)", "accum_withdraw": "sum(withdraw)"}
    cols += [f"{rnd(e)} AS {n}" for n, e in sums.items()]
    cols += [f"{rnd(div(e, 'avg(bet_amount)'))} AS {n}_ratio" for n, e in sums.items()]
    cols += [f"{rnd('sum(CASE WHEN payout > bet_amount THEN 1 END) / count(user_id)')} AS payout_rate", f"{rnd('sum(CASE WHEN profit > 0 THEN 1 ELSE 0 END) / count(user_id)')} AS profit_rate"]
    cols += ["count(deposit) AS num_deposit", "count(withdraw) AS num_withdraw"]
    for m, over in (("bet_amount", "bet_amount"), ("delta_bet_amount", "bet_amount"), ("payout", "bet_amount"), ("delta_payout", "bet_amount"), ("balance_after_bet", "balance_after_bet")):
        for n, top, low in (("cv", "stddev_samp", "abs(avg({}))"), ("drawdown", "min", "avg({})"), ("spike", "max", "avg({})")):
            e = div(f"{top}({m})", low.format(over))
            cols.append(f"{rnd(f'coalesce({e}, 0.0)' if m.startswith('delta') else e)} AS {m}_{n}")
    cols += [f"{rnd(div('stddev_samp(profit)', 'abs(avg(profit))'))} AS profit_cv", *(f"{rnd(div(f'{x}(profit)', 'avg(bet_amount)'))} AS {x}_profit_ratio" for x in ("min", "max"))]
    having = f" HAVING count(user_id) = {size}" if full else ""
    drop = " AND ".join(f"{k} IS NOT NULL" for k in key)
    return f"""{_with("raw_stats", part)},
b AS (SELECT *, CAST((session_bet_index - 1) // {size} AS BIGINT) AS agg_group, payout / nullif(CAST(bet_amount AS DOUBLE), 0) AS rtp FROM raw_stats)
SELECT {", ".join(cols)} FROM b WHERE {drop} GROUP BY {", ".join(key)}{having}"""


QUERIES = {
    "feat_user_bets": _upto(P.user_bets),
    "feat_free_game_group": _upto(P.free_game_group),
    "feat_agg_free_game": _upto(P.agg_free_game),
    "feat_delta_stats": _upto(P.delta_stats),
    "feat_user_group": _upto(P.user_group),
    "features_enriched": _upto(P.raw_stats),
    "features_grouped": _grouped(3, True),
    "features_grouped_by_table": _grouped(5, False),
}
SQL = {
    "feat_user_bets": _step_sql("user_bets"),
    "feat_free_game_group": _step_sql("free_game_group"),
    "feat_agg_free_game": _step_sql("agg_free_game"),
    "feat_delta_stats": _step_sql("delta_stats"),
    "feat_user_group": _step_sql("user_group"),
    "features_enriched": _step_sql("raw_stats"),
    "features_grouped": _grouped_sql(3, True),
    "features_grouped_by_table": _grouped_sql(5, False),
}
