"""Queries of filters, labels, cells and encodings, and their SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from driftwell.functions.columns import rounded
from driftwell.operators import prep as P
from driftwell.sources.tables import BETS_SQL, LOGS_SQL, ORDERS_SQL, bets, load, logs, orders_raw

#: Rates of an example.
RATES = {"USD": 7.1, "CNY": 1.0}
GROUPS = {"AI": "a", "AB_TEST_A": "b"}
FILTER = P.BetFilter(date(2024, 1, 3), date(2024, 1, 20), ("CNY", "USD"), "G1", ("TEST",), GROUPS, ("AI", "Default"))


def _events(build):
    return lambda spark, d: rounded(build(load(spark, d, "events")))


def _base(e):
    return P.base_bets(orders_raw(e), FILTER).select("spin_id", "user_id", "created_at", "bet_type", "bet_amount", "payout", "ai_group", "op_code")


def _dashboard(e):
    b = bets(e).withColumn("day", F.to_date("created_at"))
    b = P.chosen(b, {"ai_group": ["AI", "Default"], "bet_type": ["all"], "table_id": []})
    return P.between_dates(b, "day", date(2024, 1, 5), date(2024, 1, 9)).groupBy("day", "ai_group").agg(F.count("*").alias("n"))


def _threshold(e):
    return P.without_zeros(P.split_threshold(P.numeric_only(e.withColumn("k", e.value - 50)), {"value": 30, "k": 0}), ["value", "user_id"])


def _split(spark, d):
    return P.split_columns(load(spark, d, "part").select("p_partkey", "p_name", "p_type"), "p_name", "[ ,]", "part")


def _results(e):
    text = F.concat_ws(",", *(((F.col("event_id") + i) % 7).cast("string") for i in range(6)), F.when(F.col("event_id") % 3 == 0, "x"), F.lit("9"))
    return e.select("event_id", *P.result_cells(F.concat(text, F.lit(";"))))


def _labels(e):
    name = F.concat_ws("_", F.lit("player"), F.when(e.user_id % 2 == 0, F.concat(F.lit("cluster"), (e.user_id % 9).cast("string"))), e.event_type)
    quoted = F.concat(F.lit(" \""), F.upper(F.md5(e.user_id.cast("string").cast("binary"))), F.lit("\" "))
    return e.select(
        "event_id",
        P.policy(e.ts, "2024-01-15 12:00:00").alias("math_policy"),
        P.cluster_of(name).alias("cluster"),
        P.bare_id(quoted).alias("bare"),
        P.arm_of(quoted).alias("arm"),
        P.code_name(e.user_id % 3, {0: "deposit", 1: "withdrawal"}).alias("transaction_type"),
        P.nearest_level(e.value, [1.0, 10.0, 50.0]).alias("level"),
        P.gap_band(e.value, 5.0, 40.0).alias("band"),
        P.in_currency(e.value, F.when(e.user_id % 2 == 0, "USD").otherwise("EUR"), RATES).alias("cny"),
        P.to_number(F.when(e.event_id % 4 == 0, "n/a").when(e.event_id % 4 == 1, "Infinity").otherwise(e.value.cast("string"))).alias("number"),
        *P.one_hot("event_type", ["click", "view"]),
    )


def _index(e):
    return P.string_index(e.select("event_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type")), "event_type", "event_index")


def _bought(e):
    return P.relabel_bought(bets(e), 0).select("spin_id", "user_id", "table_id", "mathtable", "buy_free_game")


def _html(spark, d):
    return load(spark, d, "pages").select("page_id", F.md5(P.html_to_text(F.col("html")).cast("binary")).alias("digest"), F.length(P.html_to_text(F.col("html"))).alias("n"))


def _maps(e):
    m = F.create_map(F.lit("type"), F.col("event_type"), F.lit("day"), F.date_format("ts", "yyyy-MM-dd"))
    return e.select("event_id", F.explode(m).alias("key", "value")).groupBy("key", "value").agg(F.count("*").alias("n"))


QUERIES = {
    "base_filter": _events(_base), "dashboard_filter": _events(_dashboard), "threshold_split": _events(_threshold), "split_columns": _split, "result_cells": _events(_results),
    "label_columns": _events(_labels), "string_index": _events(_index), "bought_games": _events(_bought), "html_text": _html, "log_flattening": _events(lambda e: P.flat_logs(logs(e))), "map_cells": _events(_maps),
}

_R = lambda e, n: f"round(CAST({e} AS DOUBLE), 6) + 0.0 AS {n}"
_HTML = "regexp_replace(html, '(?i)<br\\s*/?>|</(?:p|div|li|tr|h[1-6])\\s*>', chr(10), 'g')"
_HTML = f"regexp_replace({_HTML}, '<[^>]*>', ' ', 'g')"
for _entity, _put in P.ENTITIES:
    _HTML = "replace({}, '{}', '{}')".format(_HTML, _entity, _put.replace("'", "''"))
_HTML = f"regexp_replace(regexp_replace({_HTML}, '[ \\t\\r]+', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g')"
_HTML = f"regexp_replace({_HTML}, '^\\s+|\\s+$', '', 'g')"
_CELLS = ", ".join([*(f"CAST((event_id + {i}) % 7 AS VARCHAR)" for i in range(6)), "CASE WHEN event_id % 3 = 0 THEN 'x' END", "'9'"])
_NAME = "concat_ws('_', 'player', CASE WHEN user_id % 2 = 0 THEN 'cluster' || (user_id % 9) END, event_type)"
SQL = {
    "base_filter": f"""WITH {ORDERS_SQL} SELECT spin_id, user_id, created_at, bet_type, {_R("bet_amount", "bet_amount")}, {_R("payout", "payout")}, CASE partition_ab[1] WHEN 'a' THEN 'AI' WHEN 'b' THEN 'AB_TEST_A' ELSE 'Default' END AS ai_group, op_code
      FROM orders_raw WHERE created_at >= '2024-01-03' AND created_at < '2024-01-20' AND currency_type IN ('CNY', 'USD') AND status = 'COMPLETED' AND game_id = 'G1' AND op_code NOT IN ('TEST')
      AND (partition_ab[1] = 'a' OR partition_ab[1] IS NULL OR partition_ab[1] NOT IN ('a', 'b'))""",
    "dashboard_filter": f"WITH {BETS_SQL} SELECT CAST(created_at AS DATE) AS day, ai_group, count(*) AS n FROM bets WHERE ai_group IN ('AI', 'Default') AND CAST(created_at AS DATE) BETWEEN '2024-01-05' AND '2024-01-09' GROUP BY ALL",
    "threshold_split": f"""WITH e AS (SELECT event_id, user_id, value, value - 50 AS k FROM events) SELECT event_id, user_id, {_R("value", "value")}, {_R("k", "k")}, {_R("CASE WHEN value <= 30 THEN value END", "value_below_30")}, {_R("CASE WHEN value > 30 THEN value END", 'value_above_30')},
      {_R("CASE WHEN k <= 0 THEN k END", 'k_below_0')}, {_R("CASE WHEN k > 0 THEN k END", 'k_above_0')} FROM e WHERE value > 1e-10 AND user_id > 1e-10""",
    "split_columns": "WITH p AS (SELECT p_partkey, p_name, p_type, string_split_regex(p_name, '[ ,]') AS s FROM part) SELECT p_partkey, p_name, p_type, s[1] AS part1, s[2] AS part2 FROM p",
    "result_cells": f"WITH r AS (SELECT event_id, string_split(concat_ws(',', {_CELLS}), ',') AS s FROM events) SELECT event_id, {', '.join(f'TRY_CAST(s[{i + 1}] AS INTEGER) AS result_pos{i + 1}' for i in range(15))} FROM r",
    "label_columns": f"""SELECT event_id, CASE WHEN ts <= '2024-01-15 12:00:00' THEN 'origin' ELSE 'updated' END AS math_policy, TRY_CAST(nullif(regexp_extract({_NAME}, 'cluster(\\d+)', 1), '') AS INTEGER) AS cluster,
      upper(md5(CAST(user_id AS VARCHAR))) AS bare, lower(left(md5(CAST(user_id AS VARCHAR)), 4)) AS arm, CASE user_id % 3 WHEN 0 THEN 'deposit' WHEN 1 THEN 'withdrawal' END AS transaction_type,
      CASE WHEN abs(value - 1) <= abs(value - 10) AND abs(value - 1) <= abs(value - 50) THEN 0 WHEN abs(value - 10) <= abs(value - 50) THEN 1 ELSE 2 END AS level, CASE WHEN value <= 5 THEN 0 WHEN value <= 40 THEN 1 ELSE 2 END AS band,
      {_R("value * CASE WHEN user_id % 2 = 0 THEN 7.1 ELSE 1.0 END", "cny")}, {_R("CASE WHEN event_id % 4 >= 2 THEN value END", "number")}, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS event_type_click, CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS event_type_view FROM events""",
    "string_index": "WITH e AS (SELECT event_id, nullif(event_type, 'error') AS event_type FROM events), n AS (SELECT event_type, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS event_index FROM e WHERE event_type IS NOT NULL GROUP BY event_type) SELECT event_type, event_id, CAST(event_index AS INTEGER) AS event_index FROM e LEFT JOIN n USING (event_type)",
    "bought_games": f"WITH {BETS_SQL} SELECT spin_id, user_id, table_id, CASE WHEN table_id = 0 THEN lead(table_id) OVER (PARTITION BY user_id ORDER BY spin_id) ELSE table_id END AS mathtable, CASE WHEN table_id = 0 THEN 1 ELSE 0 END AS buy_free_game FROM bets",
    "html_text": f"SELECT page_id, md5(t) AS digest, CAST(length(t) AS INTEGER) AS n FROM (SELECT page_id, {_HTML} AS t FROM pages)",
    "log_flattening": f"""WITH {LOGS_SQL}, x AS (SELECT *, unnest(string_split(fishes, ';')) AS item, generate_subscripts(string_split(fishes, ';'), 1) AS fish_index FROM logs)
      SELECT event_id, user_id, event_time, TRY_CAST(room AS BIGINT) AS room, CAST(fish_index AS INTEGER) AS fish_index, coalesce(fish, nullif(split_part(item, '/', 1), '')) AS fish, TRY_CAST(split_part(item, '/', 2) AS INTEGER) AS fish_type, {_R("TRY_CAST(split_part(item, '/', 3) AS DOUBLE)", "cost")} FROM x""",
    "map_cells": "SELECT 'type' AS key, event_type AS value, count(*) AS n FROM events GROUP BY ALL UNION ALL SELECT 'day', strftime(ts, '%Y-%m-%d'), count(*) FROM events GROUP BY ALL",
}
