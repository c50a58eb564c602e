import math
import random
import statistics
from datetime import date, datetime
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from driftwell.functions import columns as C
from driftwell.operators import features as P
from driftwell.operators import groupstats as G
from driftwell.operators import joins as J
from driftwell.operators import retrieval as R
from driftwell.operators import userstats as U
from driftwell.sources import incremental as I
from driftwell.streaming.sessions import session_counts

BETS = "spin_id long, user_id long, created_at timestamp, bet_type string, bet_amount double, payout double, ai_group string, balance_after_bet double, balance_after_payout double"


def bet(i, kind="BASE", bet_amount=1.0, payout=0.0, sec=None):
    return (i, 1, datetime.fromtimestamp(1_700_000_000 + (i if sec is None else sec)), kind, bet_amount, float(payout), "AI", 10.0, 10.0 + payout)


def test_leading_free_games_form_group_zero(spark):
    rows = [bet(1, "FREE"), bet(2, "FREE"), bet(3), bet(4, "FREE")]
    cfg = P.FeatureConfig()
    out = spark.createDataFrame(rows, BETS)
    for step in (P.user_bets, P.free_game_group, P.agg_free_game):
        out = out.transform(step, cfg)
    got = {r["fg_group"]: (r["fg_rounds"], r["bet_amount"]) for r in out.collect()}
    assert got == {0: (2, None), 1: (1, 1.0)}


def test_session_breaks_only_above_the_threshold(spark):
    cfg = P.FeatureConfig(session_break=10)
    rows = [bet(1, sec=0), bet(2, sec=9), bet(3, sec=19), bet(4, sec=30)]
    out = P.enriched(spark.createDataFrame(rows, BETS), cfg).orderBy("spin_id").collect()
    assert [r["session_bet_index"] for r in out] == [1, 2, 3, 1]


def test_ties_end_both_streaks(spark):
    rows = [bet(1, payout=2), bet(2, payout=2), bet(3, payout=0), bet(4, payout=1), bet(5, payout=2)]
    out = P.enriched(spark.createDataFrame(rows, BETS), P.FeatureConfig()).orderBy("spin_id").collect()
    assert [r["win_streak"] for r in out] == [1, 2, None, None, 1]
    assert [r["lose_streak"] for r in out] == [None, None, 1, None, None]


def test_config_is_checked():
    with pytest.raises(ValueError):
        P.FeatureConfig(bin_sizes=(0,))
    assert P.FeatureConfig(session_break=86_401).lookback_days == 3


def test_asof_keeps_unmatched_and_takes_equal_times(spark):
    left = spark.createDataFrame([(1, 5), (1, 1), (2, 9)], "k int, t int")
    right = spark.createDataFrame([(1, 3, "a"), (1, 5, "b")], "k int, s int, v string")
    got = {(r["k"], r["t"]): r["v"] for r in J.asof(left, right, "k", "t", "s", ["v"]).collect()}
    assert got == {(1, 5): "b", (1, 1): None, (2, 9): None}


def test_clip_keeps_null_and_unbound_sides(spark):
    out = spark.createDataFrame([(None,), (5.0,), (-5.0,)], "x double").select(C.clip(F.col("x"), F.lit(None).cast("double"), F.lit(1.0)).alias("y")).collect()
    assert [r["y"] for r in out] == [None, 1.0, -5.0]


def test_row_filters_switch_off(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert C.row_filters(df, {"a": [], "b": 3}).count() == 2
    assert C.row_filters(df, {"a": [2, 7]}).count() == 1


def test_chunk_edges(spark):
    df = spark.createDataFrame([(n, "x" * n) for n in (0, 10, 11, 18)], "id int, text string")
    got = {}
    for r in R.chunks(df, "text", 10, 2).collect():
        got.setdefault(r["id"], []).append(len(r["chunk"]))
    assert got == {10: [10], 11: [10, 3], 18: [10, 10]}


def test_fusion_is_one_based(spark):
    one = spark.createDataFrame([(1, 1), (2, 2)], "id int, rank int")
    assert R.fuse([one, one], 5).first()["score"] == round(2 / 61, 9)


def test_read_only_guard():
    I.read_only("SELECT 'drop' -- delete\nFROM t")
    with pytest.raises(ValueError):
        I.read_only("DROP TABLE t")


def test_start_dates():
    assert I.start_date(None, date(2024, 1, 1), 3) == date(2024, 1, 1)
    assert I.start_date(date(2024, 3, 20), date(2024, 1, 1), 7) == date(2024, 3, 11)
    assert I.start_date(date(2024, 3, 20), date(2024, 1, 1), 31) == date(2024, 2, 1)


def test_late_rows_replace_and_new_columns_reload(spark, tmp_path):
    path = str(tmp_path / "out")
    make = lambda rows, schema="k int, d date, v int": lambda s, start: s.createDataFrame(rows, schema).where(F.col("d") >= F.lit(start))
    I.run_incremental(spark, path, make([(1, date(2024, 1, 1), 1), (2, date(2024, 1, 2), 1)]), ["k"], "d", date(2024, 1, 1))
    I.run_incremental(spark, path, make([(2, date(2024, 1, 2), 5), (3, date(2024, 1, 3), 1)]), ["k"], "d", date(2024, 1, 1), 1)
    assert {(r["k"], r["v"]) for r in spark.read.parquet(path).collect()} == {(1, 1), (2, 5), (3, 1)}
    I.run_incremental(spark, path, make([(9, date(2024, 1, 1), 1, 2)], "k int, d date, v int, w int"), ["k"], "d", date(2024, 1, 1))
    assert [r["k"] for r in spark.read.parquet(path).collect()] == [9]


def test_drift_is_refused(spark, tmp_path):
    path = str(tmp_path / "set")
    I.check_drift(spark, path, {"a": 1})
    with pytest.raises(ValueError):
        I.check_drift(spark, path, {"a": 2})
    I.check_drift(spark, path, {"a": 2}, overwrite=True)


def test_align_widens_types(spark):
    out = I.align([spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(1.5, "x")], "a double, b string")])
    assert out.dtypes == [("a", "double"), ("b", "string")]
    assert out.count() == 2


def test_stream_equals_batch(spark, tmp_path):
    from conftest import DATA

    events = spark.read.parquet(f"{DATA}/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = session_counts(stream).writeStream.format("memory").queryName("sessions").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    batch = session_counts(events)
    done = spark.table("sessions").count()
    assert 0 < done <= batch.count()


def test_read_only_guard_strips_every_kind_of_comment():
    I.read_only('SELECT 1 # drop table\n/* delete\nfrom t */ AS "update" -- merge')
    for sql in ("SELECT 1; DELETE FROM t", "/* x */ insert into t values (1)"):
        with pytest.raises(ValueError):
            I.read_only(sql)


def test_incremental_reads_only_touched_days_and_breaks_ties(spark, tmp_path):
    path = str(tmp_path / "days")
    make = lambda rows: lambda s, start: s.createDataFrame(rows, "k int, d date, v int").where(F.col("d") >= F.lit(start))
    I.run_incremental(spark, path, make([(i, date(2024, 1, i), i) for i in range(1, 10)]), ["k"], "d", date(2024, 1, 1))
    plan = I.touched_days(spark.read.parquet(path), date(2024, 1, 8))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan.split("PartitionFilters")[1].split("]")[0]
    assert I.watermark(spark, path) == date(2024, 1, 9)
    same = [(9, date(2024, 1, 9), v) for v in (7, 5, 6)] + [(9, date(2024, 1, 8), 1)]
    for _ in range(2):
        I.run_incremental(spark, path, make(same), ["k"], "d", date(2024, 1, 1), 1)
        got = {r["k"]: (r["d"].day, r["v"]) for r in spark.read.parquet(path).collect()}
        assert got == {i: (i, i) for i in range(1, 9)} | {9: (9, 5)}


def test_literals_and_binding():
    from driftwell.sources import readers as R_

    assert R_.bound("a = {a} AND b IN {b} AND c IS {c} AND d = {d} AND e = {e}", {"a": "x'y", "b": [1, "z"], "c": None, "d": True, "e": date(2024, 1, 2)}) == "a = 'x''y' AND b IN (1, 'z') AND c IS NULL AND d = TRUE AND e = '2024-01-02'"
    with pytest.raises(TypeError):
        R_.literal(object())


def test_catalog_keeps_queries_and_binds_parameters(spark):
    from conftest import DATA

    from driftwell.sources.readers import Catalog

    catalog = Catalog(spark).register(DATA, ["region", "nation"])
    got = catalog.query("SELECT r_name FROM region WHERE r_regionkey = :key", {"key": 2}, keep=True)
    assert got.count() == 1 and catalog.query("SELECT r_name FROM region WHERE r_regionkey = :key", {"key": 2}) is got
    assert catalog.query("SELECT r_name FROM region WHERE r_regionkey = :key", {"key": 2}, reload=True) is not got
    with pytest.raises(ValueError):
        catalog.query("DROP TABLE region")


def test_many_files_are_aligned_filtered_and_partly_readable(spark, tmp_path):
    from driftwell.sources import readers as R_
    from driftwell.sources import sinks as K

    K.write_csv(spark.createDataFrame([(1, "a"), (2, "b")], "x int, s string").coalesce(1), str(tmp_path / "one.csv"))
    K.write_parquet(spark.createDataFrame([(2.5, 7), (1.0, 8)], "x double, y int").coalesce(1), str(tmp_path / "two"))
    (tmp_path / "bad.parquet").write_text("no parquet")
    files = R_.expand(spark, str(tmp_path))
    assert len(files) == 3 and all(f.endswith((".csv.gz", ".parquet")) for f in files)
    df = R_.read_many(spark, [str(tmp_path), str(tmp_path / "none.csv")], source_col="file")
    assert dict(df.dtypes) == {"file": "string", "s": "string", "x": "double", "y": "int"} and df.count() == 4
    assert R_.read_many(spark, files[-2:] + files[:1], columns=["x", "z"], filters={"x": [1, 2]}, types={"x": "int"}).count() >= 2
    with pytest.raises(ValueError):
        R_.read_many(spark, [str(tmp_path / "none.csv")])
    assert R_.read_csv_sampled(spark, [str(tmp_path / "one.csv")], ["s", "t"], sample=1).count() == 1
    assert R_.read_csv_sampled(spark, [str(tmp_path / "one.csv")], ["s"], {"x": 2}).collect()[0]["s"] == "b"
    (tmp_path / "raw.csv").write_text("1,2,3\n4,5,6\n")
    assert R_.read_headerless(spark, [str(tmp_path / "raw.csv")], ["a", "b", "c"], ["c", "a"]).collect()[1]["c"] == 6
    assert R_.read_one(spark, str(tmp_path / "raw.csv")).columns == ["1", "2", "3"]


def test_since_and_table_sample(spark):
    from driftwell.sources import readers as R_

    df = spark.createDataFrame([(date(2024, 1, i),) for i in range(1, 10)], "d date")
    assert R_.since(df, "d", "2024-01-04").count() == 6
    with pytest.raises(ValueError):
        R_.since(df, "d", "04/01/2024")
    some = R_.table_sample(spark.range(100_000), 10, 3).count()
    assert 9_000 < some < 11_000


def test_sinks_write_what_is_read_back(spark, tmp_path):
    from driftwell.sources import sinks as K

    df = spark.createDataFrame([(1, "a", 0.5), (2, "b", None)], "k int, c string, x double")
    K.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    K.fan_out(df, str(tmp_path / "f"), "c")
    assert sorted(p.name for p in (tmp_path / "f").glob("c=*")) == ["c=a", "c=b"]
    assert K.write_stats(df, str(tmp_path / "s")) == '[{"c": "a", "k": 1, "x": 0.5}, {"c": "b", "k": 2}]'
    K.save_view(df, "some_view")
    assert spark.table("some_view").count() == 2
    K.append_cache(df, str(tmp_path / "c"))
    out = K.append_cache(spark.createDataFrame([(3, 9)], "k int, n int"), str(tmp_path / "c"))
    assert out.count() == 3 and sorted(out.columns) == ["c", "k", "n", "x"]


def test_vector_index_round_trip(spark, tmp_path):
    from driftwell.sources import sinks as K

    chunks = spark.createDataFrame([(1, "a", [3.0, 4.0]), (2, "b", [0.0, 0.0])], "id int, text string, embedding array<double>")
    K.save_index(chunks, str(tmp_path / "index"))
    got = {r["id"]: r["embedding"] for r in K.load_index(spark, str(tmp_path / "index")).collect()}
    assert got == {1: [0.6, 0.8], 2: [0.0, 0.0]}
    chunks.limit(1).write.mode("overwrite").parquet(str(tmp_path / "index/chunks"))
    with pytest.raises(ValueError):
        K.load_index(spark, str(tmp_path / "index"))


def test_submitted_queries_give_their_rows(spark):
    from conftest import DATA

    from driftwell.sources.readers import Catalog

    catalog = Catalog(spark).register(DATA, ["nation"])
    one, two = catalog.submit("SELECT count(*) AS n FROM nation"), catalog.submit("SELECT n_name FROM nation WHERE n_nationkey < :k", {"k": 3})
    assert one.result(120).first()["n"] == 25 and two.result(120).count() == 3
    with pytest.raises(ValueError):
        catalog.submit("DELETE FROM nation")
    catalog.stop(catalog.submit("SELECT 1 AS x"))


def test_tumbling_stream_equals_batch(spark, tmp_path):
    from conftest import DATA

    from driftwell.streaming.windows import once, tumbling

    events = spark.read.parquet(f"{DATA}/events.parquet")
    events.unionByName(events.limit(50)).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = tumbling(once(stream), late=None).writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda r: (r["start"], r["event_type"], r["n"], round(r["value"], 6))
    assert sorted(map(key, spark.table("windows").collect())) == sorted(map(key, tumbling(events).collect()))


def test_profit_spread_is_not_rounding(spark):
    schema = "user_id long, event_timestamp timestamp, room_id long, strategy_name string, bet double, payout double, fish_value long, killed int"
    at = datetime(2024, 1, 3)
    pairs = {1: [(0.1, 0.0), (0.2, 0.0), (0.0, 0.3)], 2: [(0.1, 0.0), (0.7, 0.0), (0.0, 0.81)] * 40, 3: [(1e-13, 3e-13), (0.0, 2e-13)], 4: [(None, 1.0), (1.0, 3.0), (1.0, 5.0)]}
    rows = [(u, at, 1, "AI", b, p, 5, 1) for u, profits in pairs.items() for b, p in profits]
    for grain in ("day", "week", "month"):
        got = {r["user_id"]: r["profit_cv"] for r in U.shooter_user_stats(spark.createDataFrame(rows, schema).coalesce(1), grain).collect()}
        assert got[1] is None  # they cancel out
        values = [Fraction(str(p)) - Fraction(str(b)) for b, p in pairs[2]]
        mean = sum(values) / len(values)
        std = math.sqrt(sum((x - mean) ** 2 for x in values) / (len(values) - 1))
        assert got[2] == pytest.approx(std / abs(float(mean)), rel=1e-14)
        assert got[3] == pytest.approx(0.0, abs=1e-12) and got[4] == pytest.approx(math.sqrt(2) / 3)


def test_percentiles_are_exact(spark):
    """Each quartile is the least value that its share of the rows is at or below, at any accuracy of the sketch."""
    n = 60_001
    wide = spark.range(n).select(F.when(F.col("id") % 2 == 0, "a").alias("g"), ((F.col("id") * 7919) % n).cast("double").alias("x"))  # one group is null
    few = spark.createDataFrame([("b", 1.0), ("b", 1.0), ("b", 2.0), ("b", None), ("c", None)], "g string, x double")
    df = wide.unionByName(few)
    want = {"b": [1.0, 1.0, 2.0], "c": [None] * 3}
    for g, start in (("a", 0), (None, 1)):
        values = sorted(float(i * 7919 % n) for i in range(start, n, 2))
        want[g] = [values[math.ceil(p * len(values)) - 1] for p in (0.25, 0.5, 0.75)]
    for accuracy in (10_000, 10):
        rows = G.approximate_percentiles(df, ["g"], "x", accuracy).collect()
        assert {r["g"]: [r["p25"], r["median"], r["p75"]] for r in rows} == want and len(rows) == 4


def test_profit_spread_does_not_depend_on_order(spark):
    schema = "user_id long, event_timestamp timestamp, room_id long, strategy_name string, bet double, payout double, fish_value long, killed int"
    draw = random.Random(3)
    cents = [draw.randrange(20_000) for _ in range(1_499)]
    pays = [100 * draw.randrange(200) for _ in range(1_500)]
    pairs = list(zip([*cents, sum(pays) - sum(cents) - 1], pays, strict=True))  # profits of one cent in all
    orders = {1: pairs, 2: sorted(pairs), 3: sorted(pairs, key=lambda x: x[1] - x[0]), 4: draw.sample(pairs, len(pairs))}
    profits = {5: [1e-8, 3e-8, -1e-8], 6: [1e6, 1e6 + 0.01], 7: [1e13, -3e13, 1e12], 8: [2.5], 9: [0.5, 0.5], 10: [0.1, -0.3, 7.0]}
    rows = [(u, b / 100, p / 100) for u, o in orders.items() for b, p in o] + [(u, 0.0, p) for u, o in profits.items() for p in o]
    events = spark.createDataFrame([(u, datetime(2024, 1, 3), 1, "AI", b, p, 5, 1) for u, b, p in rows], schema).coalesce(1)
    got = {r["user_id"]: r["profit_cv"] for r in U.shooter_user_stats(events, "week").collect()}
    values = [Fraction(p - b, 100) for b, p in pairs]
    mean = sum(values) / len(values)
    want = math.sqrt(sum((x - mean) ** 2 for x in values) / (len(values) - 1)) / float(mean)
    assert mean > 0 and len({got[u] for u in orders}) == 1 and got[1] == pytest.approx(want, rel=5e-16, abs=0)
    for u, x in profits.items():
        assert got[u] == (None if len(x) < 2 else pytest.approx(statistics.stdev(x) / abs(statistics.fmean(x)), rel=1e-9))
