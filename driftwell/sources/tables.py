"""Tables of a folder, and the logical views that queries read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k(props) -> F.Column:
    return F.get_json_object(props, "$.k").try_cast("long")


def bets(events: DataFrame) -> DataFrame:
    """Slot bets from events: errors stand for free games."""
    k = _k(F.col("props"))
    return events.select(
        F.col("event_id").alias("spin_id"),
        "user_id",
        F.col("ts").alias("created_at"),
        F.when(F.col("event_type") == "error", "FREE").otherwise("BASE").alias("bet_type"),
        F.col("value").alias("bet_amount"),
        k.cast("double").alias("payout"),
        ((F.col("user_id") + F.floor(F.col("event_id") / 400)) % 3).alias("table_id"),
        F.when(F.col("user_id") % 4 == 0, "AI").when(F.col("user_id") % 4 == 1, "AB_TEST_A").otherwise("Default").alias("ai_group"),
        (F.lit(1000.0) + (F.col("event_id") % 7) * 10 - F.col("value")).alias("balance_after_bet"),
        (F.lit(1000.0) + (F.col("event_id") % 7) * 10 - F.col("value") + k).alias("balance_after_payout"),
    )


BETS_SQL = """bets AS (SELECT event_id AS spin_id, user_id, ts AS created_at, CASE WHEN event_type = 'error' THEN 'FREE' ELSE 'BASE' END AS bet_type,
  value AS bet_amount, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS payout, (user_id + event_id // 400) % 3 AS table_id,
  CASE user_id % 4 WHEN 0 THEN 'AI' WHEN 1 THEN 'AB_TEST_A' ELSE 'Default' END AS ai_group,
  1000.0::DOUBLE + (event_id % 7) * 10 - value AS balance_after_bet,
  1000.0::DOUBLE + (event_id % 7) * 10 - value + CAST(json_extract_string(props, '$.k') AS BIGINT) AS balance_after_payout FROM events)"""


def bullets(events: DataFrame) -> DataFrame:
    """Shooter bets from events: purchases stand for kills."""
    k = _k(F.col("props"))
    return events.select(
        F.col("event_id").alias("bullet_id"),
        "user_id",
        F.col("ts").alias("event_timestamp"),
        (k % 5).alias("room_id"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 16).cast("string")).alias("ip"),
        F.when(F.col("event_type").isin("view", "click"), "AI").otherwise("Default").alias("strategy_name"),
        F.col("value").alias("bet"),
        k.cast("double").alias("payout"),
        (k * 3).alias("fish_value"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("killed"),
        F.when(k % 7 != 0, F.concat(F.lit("device"), F.floor(k / 50).cast("string"))).alias("device_type"),
        F.when(F.col("user_id") % 3 == 0, "USD").otherwise("CNY").alias("currency_type"),
    )


BULLETS_SQL = """bullets AS (SELECT event_id AS bullet_id, user_id, ts AS event_timestamp, CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 AS room_id,
  '10.0.0.' || (user_id % 16) AS ip, CASE WHEN event_type IN ('view', 'click') THEN 'AI' ELSE 'Default' END AS strategy_name, value AS bet,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS payout, CAST(json_extract_string(props, '$.k') AS BIGINT) * 3 AS fish_value,
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS killed,
  CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 7 <> 0 THEN 'device' || (CAST(json_extract_string(props, '$.k') AS BIGINT) // 50) END AS device_type,
  CASE WHEN user_id % 3 = 0 THEN 'USD' ELSE 'CNY' END AS currency_type FROM events)"""


def orders_raw(events: DataFrame) -> DataFrame:
    """Slot bets before any filter, with all that the feature pipeline's filter looks at."""
    key = F.col("event_id")
    return bets(events).join(
        events.select(
            key.alias("spin_id"),
            F.when(F.col("user_id") % 5 == 0, "USD").when(F.col("user_id") % 5 == 1, "PHP").otherwise("CNY").alias("currency_type"),
            F.when(key % 11 == 0, "FAILED").otherwise("COMPLETED").alias("status"),
            F.concat(F.lit("G"), (F.col("user_id") % 2).cast("string")).alias("game_id"),
            F.when(key % 13 == 1, "TEST").when(key % 13 > 1, "OP").alias("op_code"),
            F.when(F.col("user_id") % 4 == 0, F.array(F.lit("a"))).when(F.col("user_id") % 4 == 1, F.array(F.lit("b"), F.lit("x"))).when(F.col("user_id") % 4 == 2, F.array().cast("array<string>")).alias("partition_ab"),
        ),
        "spin_id",
    )


ORDERS_SQL = f"""{BETS_SQL},
orders_raw AS (SELECT bets.*, CASE e.user_id % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'PHP' ELSE 'CNY' END AS currency_type, CASE WHEN event_id % 11 = 0 THEN 'FAILED' ELSE 'COMPLETED' END AS status,
  'G' || (e.user_id % 2) AS game_id, CASE WHEN event_id % 13 = 1 THEN 'TEST' WHEN event_id % 13 > 1 THEN 'OP' END AS op_code,
  CASE e.user_id % 4 WHEN 0 THEN ['a'] WHEN 1 THEN ['b', 'x'] WHEN 2 THEN CAST([] AS VARCHAR[]) END AS partition_ab FROM bets JOIN events e ON e.event_id = bets.spin_id)"""


def transactions(events: DataFrame) -> DataFrame:
    """Deposits (0) and withdrawals (1): signups and errors stand for them."""
    kind = F.when(F.col("event_type") == "signup", 0).otherwise(1)
    return events.where(F.col("event_type").isin("signup", "error")).select("user_id", kind.alias("type"), F.col("value").alias("amount"), F.col("ts").alias("processed_at"))


TRANSACTIONS_SQL = "transactions AS (SELECT user_id, CASE WHEN event_type = 'signup' THEN 0 ELSE 1 END AS type, value AS amount, ts AS processed_at FROM events WHERE event_type IN ('signup', 'error'))"


def logs(events: DataFrame) -> DataFrame:
    """Log lines with a map of strings; ``fishes`` packs up to four id/type/cost."""
    item = lambda i: F.concat_ws("/", (F.col("event_id") + i).cast("string"), (F.col("user_id") % (i + 2)).cast("string"), F.when(F.col("event_id") % 5 == 0, "none").otherwise(F.lit(str(10 * i))))
    packed = F.array_join(F.slice(F.array(*(item(i) for i in range(4))), 1, (F.col("event_id") % 4).cast("int") + 1), ";")
    fields = F.map_filter(F.create_map(F.lit("room"), (F.col("user_id") % 5).cast("string"), F.lit("fish"), F.when(F.col("event_id") % 3 == 0, F.lit("single")), F.lit("fishes"), packed), lambda k, v: v.isNotNull())
    return events.select("event_id", "user_id", F.col("ts").alias("event_time"), fields.alias("fields"))


_ITEM = lambda i: f"concat_ws('/', CAST(event_id + {i} AS VARCHAR), CAST(user_id % {i + 2} AS VARCHAR), CASE WHEN event_id % 5 = 0 THEN 'none' ELSE '{10 * i}' END)"
LOGS_SQL = f"""logs AS (SELECT event_id, user_id, ts AS event_time, CAST(user_id % 5 AS VARCHAR) AS room, CASE WHEN event_id % 3 = 0 THEN 'single' END AS fish,
  array_to_string(list_slice([{", ".join(map(_ITEM, range(4)))}], 1, event_id % 4 + 1), ';') AS fishes FROM events)"""
