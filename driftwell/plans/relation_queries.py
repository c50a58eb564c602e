"""Queries of joins, set operations, reshaping and scalar functions, and their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from driftwell.functions import columns as C
from driftwell.operators import joins as J
from driftwell.operators.islands import gap_flags
from driftwell.operators.userstats import weekly_compare
from driftwell.sources.tables import load


def _asof(spark, d):
    e = load(spark, d, "events")
    buys = e.where("event_type = 'purchase'").select("event_id", "user_id", F.col("ts").alias("bought_at"))
    views = e.where("event_type = 'view'").select("user_id", F.col("ts").alias("viewed_at"), F.col("value").alias("view_value"))
    return J.asof(buys, views, "user_id", "bought_at", "viewed_at", ["view_value"])


def _band(spark, d):
    e = load(spark, d, "events")
    first = e.groupBy("user_id").agg(F.min("ts").alias("first_ts"))
    near = J.band(first, e.select("user_id", "event_id", "ts", "event_type"), "user_id", "first_ts", "ts", 86_400)
    return near.groupBy("user_id").agg(F.count("*").alias("n"), F.max("ts").alias("last_ts"))


def _upsert(spark, d):
    c = load(spark, d, "customer")
    old = c.where("c_custkey % 3 <> 0").select("c_custkey", "c_mktsegment", "c_acctbal")
    new = c.where("c_custkey % 2 = 0").select("c_custkey", F.when(F.col("c_custkey") % 4 == 0, "NEW").alias("c_mktsegment"), F.col("c_nationkey"))
    return J.upsert(old, new, ["c_custkey"])


def _difference(spark, d):
    o, c = load(spark, d, "orders"), load(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("id")).subtract(o.where("o_totalprice > 250000").select(F.col("o_custkey").alias("id")))


def _intersection(spark, d):
    o, c = load(spark, d, "orders"), load(spark, d, "customer")
    return c.where("c_acctbal > 0").select(F.col("c_custkey").alias("id")).intersect(o.where("o_totalprice > 250000").select(F.col("o_custkey").alias("id")))


def _semi_anti(spark, d):
    o, c = load(spark, d, "orders"), load(spark, d, "customer")
    large = o.where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    has, none = (c.join(large, "c_custkey", how).groupBy("c_mktsegment").agg(F.count("*").alias("n")) for how in ("left_semi", "left_anti"))
    return has.select("c_mktsegment", F.lit("with").alias("side"), "n").unionByName(none.select("c_mktsegment", F.lit("without").alias("side"), "n"))


def _pivot(spark, d):
    kinds = ["click", "error", "purchase", "signup", "view"]
    e = load(spark, d, "events").withColumn("day", F.to_date("ts"))
    return e.groupBy("day").pivot("event_type", kinds).agg(F.count(F.lit(1))).fillna(0)


def _top_others(spark, d):
    n = load(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.orderBy(F.desc("n"), F.asc("p_brand")))  # one row a brand
    named = n.withColumn("brand", F.when(place <= 5, F.col("p_brand")).otherwise("Others"))
    return named.groupBy("brand").agg(F.sum("n").alias("n"))


def _unpivot(spark, d):
    rows = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax").unpivot(["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], "variable", "value")
    return C.rounded(rows.where("value > 0").groupBy("variable").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.avg("value").alias("mean")))


def _resample(spark, d):
    e = load(spark, d, "events")
    return C.rounded(e.groupBy(F.window("ts", "6 hours").alias("w"), "event_type").agg(F.avg("value").alias("mean"), F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "mean", "n"))


def _gap_groups(spark, d):
    return gap_flags(load(spark, d, "events").select("event_id", "user_id", "ts"), "user_id", "ts", 43_200)


def _scalars(spark, d):
    e, hour = load(spark, d, "events"), F.hour("ts")
    k = F.get_json_object("props", "$.k").try_cast("long")
    return C.rounded(
        e.select(
            "event_id",
            C.day_part(F.col("ts")).alias("part"),
            F.dayofweek("ts").isin(1, 7).cast("int").alias("weekend"),
            F.weekday("ts").alias("weekday"),
            hour.alias("hour"),
            C.band(k, [(10, "low"), (50, "medium")], "high").alias("band"),
            C.symlog(F.col("value") - 50).alias("symlog"),
            C.clip(F.col("value"), F.lit(5.0), F.lit(80.0)).alias("clipped"),
            C.ratio(F.col("value"), k).alias("ratio"),
            F.date_format("ts", "yyyy-MM-dd").alias("day"),
            C.period_start(F.col("ts"), "week").alias("week"),
            F.to_date(F.from_utc_timestamp("ts", "Asia/Shanghai")).alias("local_day"),
        ),
        9,
    )


def _split(spark, d):
    parts = F.split("p_name", " ")
    return load(spark, d, "part").select("p_partkey", F.posexplode(parts).alias("place", "word")).groupBy("word").agg(F.count("*").alias("n"), F.max("place").alias("last_place"))


def _weekly(spark, d):
    days = load(spark, d, "events").select(F.to_date("ts").alias("day"), "value")
    return C.rounded(weekly_compare(days, "day", "value"))


def _year_over_year(spark, d):
    o = load(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("orders"), F.sum("o_totalprice").alias("price"))
    old = o.select(F.add_months("day", 12).alias("day"), F.col("orders").alias("orders_before"), F.col("price").alias("price_before"))
    return C.rounded(o.join(old, "day").withColumn("change", C.ratio(F.col("price") - F.col("price_before"), F.col("price_before"))), 4)


def _literal_map(spark, d):
    teams = spark.createDataFrame([("view", "browse"), ("click", "browse"), ("purchase", "buy")], "event_type string, team string")
    return C.rounded(load(spark, d, "events").join(F.broadcast(teams), "event_type").groupBy("team").agg(F.count_distinct("user_id").alias("users"), F.sum("value").alias("value")))  # three rows


def _mode(spark, d):
    n = load(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return J.last_by(n, ["user_id"], [F.desc("n"), F.asc("event_type")])


def _hash_sample(spark, d):
    e = load(spark, d, "events")
    keys = e.select("user_id").distinct().where(F.substring(F.md5(F.col("user_id").cast("string").cast("binary")), 1, 1) < "4")
    return e.join(keys, "user_id", "left_semi").groupBy("user_id").agg(F.count("*").alias("n"))


def _trim_ends(spark, d):
    """Each user's events without the first and last 2 distinct times."""
    first, last = (F.dense_rank().over(Window.partitionBy("user_id").orderBy(o("ts"))) for o in (F.asc, F.desc))
    return load(spark, d, "events").select("event_id", "user_id", first.alias("a"), last.alias("b")).where("a > 2 AND b > 2").select("event_id", "user_id")


def _transitions(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = load(spark, d, "events").withColumn("next_type", F.lead("event_type").over(w)).where("next_type IS NOT NULL")
    n = rows.groupBy("event_type", "next_type").agg(F.count("*").alias("n"))
    return C.rounded(n.withColumn("share", C.ratio(F.col("n"), F.sum("n").over(Window.partitionBy("event_type")))))


def _sequences(spark, d):
    """Each order's return flags in line order, and how often each sequence comes."""
    seq = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag"))), lambda x: x["l_returnflag"]), ",")
    return load(spark, d, "lineitem").groupBy("l_orderkey").agg(seq.alias("flags")).groupBy("flags").agg(F.count("*").alias("n"))


def _union_align(spark, d):
    c = load(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = load(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return c.unionByName(s, allowMissingColumns=True)


def _top10(spark, d):
    n = load(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return n.orderBy(F.desc("n"), F.asc("o_custkey")).limit(10)  # the report is a top ten


QUERIES = {
    "asof_join": _asof, "band_join": _band, "upsert_merge": _upsert, "set_difference": _difference, "set_intersection": _intersection, "semi_anti_join": _semi_anti, "pivot_day_type": _pivot,
    "top_n_others": _top_others, "unpivot_stats": _unpivot, "time_resample": _resample, "gap_groups": _gap_groups, "scalar_functions": _scalars, "split_explode": _split,
    "weekly_compare": _weekly, "year_over_year": _year_over_year, "literal_map_join": _literal_map, "mode_per_group": _mode, "group_hash_sample": _hash_sample,
    "trim_first_last": _trim_ends, "transition_matrix": _transitions, "ordered_sequences": _sequences, "union_aligned": _union_align, "top_ten": _top10,
}
_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
SQL = {
    "asof_join": "SELECT b.event_id, b.user_id, b.ts AS bought_at, v.ts AS viewed_at, v.value AS view_value FROM (SELECT * FROM events WHERE event_type = 'purchase') b ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON b.user_id = v.user_id AND b.ts >= v.ts",
    "band_join": "WITH f AS (SELECT user_id, min(ts) AS first_ts FROM events GROUP BY user_id) SELECT user_id, count(*) AS n, max(ts) AS last_ts FROM f JOIN events e USING (user_id) WHERE e.ts >= first_ts AND e.ts < first_ts + INTERVAL 86400 SECOND GROUP BY user_id",
    "upsert_merge": "WITH o AS (SELECT * FROM customer WHERE c_custkey % 3 <> 0), n AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'NEW' END AS c_mktsegment, c_nationkey FROM customer WHERE c_custkey % 2 = 0) SELECT c_custkey, coalesce(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment, o.c_acctbal, n.c_nationkey FROM o FULL JOIN n USING (c_custkey)",
    "set_difference": "SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 250000",
    "set_intersection": "SELECT c_custkey AS id FROM customer WHERE c_acctbal > 0 INTERSECT SELECT o_custkey FROM orders WHERE o_totalprice > 250000",
    "semi_anti_join": "SELECT c_mktsegment, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000) THEN 'with' ELSE 'without' END AS side, count(*) AS n FROM customer GROUP BY ALL",
    "pivot_day_type": "SELECT CAST(ts AS DATE) AS day, " + ", ".join(f"count(*) FILTER (event_type = '{k}') AS {k}" for k in ("click", "error", "purchase", "signup", "view")) + " FROM events GROUP BY ALL",
    "top_n_others": "WITH n AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, p_brand) AS r FROM n) SELECT CASE WHEN r <= 5 THEN p_brand ELSE 'Others' END AS brand, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY ALL",
    "unpivot_stats": "SELECT variable, count(*) AS n, round(min(value), 6) + 0.0 AS low, round(max(value), 6) + 0.0 AS high, round(avg(value), 6) + 0.0 AS mean FROM (UNPIVOT (SELECT l_quantity, l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax INTO NAME variable VALUE value) WHERE value > 0 GROUP BY variable",
    "time_resample": "SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS start, event_type, round(avg(value), 6) + 0.0 AS mean, count(*) AS n FROM events GROUP BY ALL",
    "gap_groups": "WITH g AS (SELECT event_id, user_id, ts, date_diff('second', lag(ts) OVER w, ts) AS gap FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) SELECT *, CAST(sum(CASE WHEN gap > 43200 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS event_group FROM g",
    "scalar_functions": f"""SELECT event_id, CASE WHEN hour(ts) < 6 THEN 'midnight' WHEN hour(ts) < 12 THEN 'morning' WHEN hour(ts) < 18 THEN 'afternoon' ELSE 'night' END AS part, CAST(dayofweek(ts) IN (0, 6) AS INTEGER) AS weekend,
      CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour, CASE WHEN {_K} <= 10 THEN 'low' WHEN {_K} <= 50 THEN 'medium' ELSE 'high' END AS band, round(sign(value - 50) * log10(abs(value - 50) + 1), 9) + 0.0 AS symlog,
      round(greatest(5.0::DOUBLE, least(value, 80.0::DOUBLE)), 9) + 0.0 AS clipped, round(value / nullif({_K}, 0), 9) + 0.0 AS ratio, strftime(ts, '%Y-%m-%d') AS day, CAST(date_trunc('week', ts) AS DATE) AS week, CAST(ts + INTERVAL 8 HOUR AS DATE) AS local_day FROM events""",
    "split_explode": "SELECT word, count(*) AS n, CAST(max(place) AS INTEGER) AS last_place FROM (SELECT unnest(string_split(p_name, ' ')) AS word, generate_subscripts(string_split(p_name, ' '), 1) - 1 AS place FROM part) GROUP BY word",
    "weekly_compare": "WITH v AS (SELECT CAST(ts AS DATE) AS day, sum(value) AS v FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (ORDER BY day DESC) AS r FROM v), m AS (SELECT avg(v) FILTER (r <= 7) AS now, avg(v) FILTER (r > 7 AND r <= 14) AS before FROM r) SELECT round(now, 6) + 0.0 AS now, round(before, 6) + 0.0 AS before, round((now - before) / before, 6) + 0.0 AS change FROM m",
    "year_over_year": "WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders, sum(o_totalprice) AS price FROM orders GROUP BY ALL), p AS (SELECT CAST(day + INTERVAL 1 YEAR AS DATE) AS day, orders AS orders_before, price AS price_before FROM o) SELECT day, orders, round(price, 4) + 0.0 AS price, orders_before, round(price_before, 4) + 0.0 AS price_before, round((price - price_before) / nullif(price_before, 0), 4) + 0.0 AS change FROM o JOIN p USING (day)",
    "literal_map_join": "SELECT CASE WHEN event_type = 'purchase' THEN 'buy' ELSE 'browse' END AS team, count(DISTINCT user_id) AS users, round(sum(value), 6) + 0.0 AS value FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY ALL",
    "mode_per_group": "SELECT user_id, event_type, n FROM (SELECT user_id, event_type, count(*) AS n, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS r FROM events GROUP BY user_id, event_type) WHERE r = 1",
    "group_hash_sample": "SELECT user_id, count(*) AS n FROM events WHERE substr(md5(CAST(user_id AS VARCHAR)), 1, 1) < '4' GROUP BY user_id",
    "trim_first_last": "SELECT event_id, user_id FROM (SELECT event_id, user_id, dense_rank() OVER (PARTITION BY user_id ORDER BY ts) AS a, dense_rank() OVER (PARTITION BY user_id ORDER BY ts DESC) AS b FROM events) WHERE a > 2 AND b > 2",
    "transition_matrix": "WITH r AS (SELECT event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type FROM events), n AS (SELECT event_type, next_type, count(*) AS n FROM r WHERE next_type IS NOT NULL GROUP BY ALL) SELECT *, round(n / sum(n) OVER (PARTITION BY event_type), 6) + 0.0 AS share FROM n",
    "ordered_sequences": "SELECT flags, count(*) AS n FROM (SELECT l_orderkey, string_agg(l_returnflag, ',' ORDER BY l_linenumber, l_returnflag) AS flags FROM lineitem GROUP BY l_orderkey) GROUP BY flags",
    "union_aligned": "SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier",
    "top_ten": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 10",
}
