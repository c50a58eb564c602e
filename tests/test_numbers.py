"""Operators on numbers that SQL can't express, against plain Python and known values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from driftwell.operators import groupstats as G
from driftwell.operators import ml as L
from driftwell.operators import prep as P
from driftwell.operators import stats as S


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(1)
    at = np.concatenate([rng.normal(c, 0.4, (60, 2)) for c in ((0, 0), (6, 0), (0, 6))])
    return spark.createDataFrame(pd.DataFrame({"k": range(180), "x": at[:, 0], "y": at[:, 1]})).cache()


def test_tails_of_distributions():
    assert L.t_tails(2.0, 10) == pytest.approx(0.0733880, abs=1e-6)
    assert L.f_tail(4.0, 3, 20) == pytest.approx(0.0220770, abs=1e-6)
    assert L.f_tail(1.0, 5, 5) == pytest.approx(0.5, abs=1e-9)
    assert L.chi2_tail(3.841458821, 1) == pytest.approx(0.05, abs=1e-8)
    assert L.t_tails(1.959963985, 1e6) == pytest.approx(0.05, abs=1e-5)
    assert [L.stars(p) for p in (0.0001, 0.005, 0.03, 0.2)] == ["***", "**", "*", ""]


def test_studentized_range_and_post_hoc(spark):
    for q, groups, free in ((3.877, 3, 10), (4.232, 5, 20), (3.314, 3, 1e6), (5.270, 3, 10)):
        want = 0.01 if q > 5 else 0.05
        assert L.range_tail(q, groups, free) == pytest.approx(want, abs=0.0003)
    assert L.range_tail(2.0 * 2**0.5, 2, 10) == pytest.approx(L.t_tails(2.0, 10), abs=1e-5)  # two groups: a t-test
    rng = np.random.default_rng(4)
    x = {"a": rng.normal(0, 1, 40), "b": rng.normal(0.2, 1, 30), "c": rng.normal(2, 3, 50)}
    df = spark.createDataFrame([(k, float(v)) for k, vs in x.items() for v in vs] + [("d", 1.0), ("a", None)], "g string, x double")
    got = L.post_hoc(df, "g", "x").set_index(["a", "b"])
    assert len(got) == 3 and got.loc[("a", "c"), "p_games_howell"] < 0.01 and got.loc[("a", "b"), "p_tukey"] > 0.3
    pooled = sum((v - v.mean()) @ (v - v.mean()) for v in x.values()) / 117
    t = (x["a"].mean() - x["b"].mean()) / (pooled * (1 / 40 + 1 / 30)) ** 0.5
    assert got.loc[("a", "b"), "p_sidak"] == pytest.approx(1 - (1 - L.t_tails(t, 117)) ** 3)
    f, p = L.anova_test(df, "g", "x")
    between = sum(len(v) * (v.mean() - np.concatenate(list(x.values())).mean()) ** 2 for v in x.values()) / 2
    assert f == pytest.approx(between / pooled) and p == pytest.approx(L.f_tail(f, 2, 117))


def test_correlation_tests_leave_out_zeros(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=50)
    y = 0.5 * x + rng.normal(size=50)
    df = spark.createDataFrame([*((float(a), float(b)) for a, b in zip(x, y)), (0.0, 5.0), (None, 1.0)], "a double, b double")
    (row,) = L.correlation_tests(df, ["a", "b"], without_zeros=True).itertuples()
    r = np.corrcoef(x, y)[0, 1]
    assert row.r == pytest.approx(r) and row.n == 50
    assert row.p == pytest.approx(L.t_tails(r * (48 / (1 - r * r)) ** 0.5, 48))
    assert L.correlation_tests(df, ["a", "b"]).n[0] == 51


def test_power_rates_are_the_likeliest(spark):
    rng = np.random.default_rng(3)
    x = np.exp(rng.normal(size=400)) - 1.5
    df = spark.createDataFrame(pd.DataFrame({"x": x}))

    def transform(r):
        up = np.log1p(np.maximum(x, 0)) if r == 0 else ((np.maximum(x, 0) + 1) ** r - 1) / r
        low = -np.log1p(np.maximum(-x, 0)) if r == 2 else -((np.maximum(-x, 0) + 1) ** (2 - r) - 1) / (2 - r)
        return np.where(x >= 0, up, low)

    grid = np.arange(-3, 3, 0.01)
    best = max(grid, key=lambda r: -0.5 * len(x) * np.log(transform(r).var()) + (r - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum())
    rate = L.power_rates(df, ["x"])["x"]
    assert rate == pytest.approx(best, abs=0.011)
    got = [r["x"] for r in L.powered(df, {"x": rate}).collect()]
    assert np.allclose(got, transform(rate))


def test_principal_components_and_importance(blobs):
    data = blobs.select("x", "y").toPandas().to_numpy()
    mean, values, parts = L.principal(blobs, ["x", "y"])
    want, vectors = np.linalg.eigh(np.cov(data.T))
    assert np.allclose(values, want[::-1]) and np.allclose(np.abs(parts), np.abs(vectors.T[::-1])) and np.allclose(mean, data.mean(0))
    pcs = L.with_components(blobs, ["x", "y"], 2).select("pc1", "pc2").toPandas()
    assert abs(np.corrcoef(pcs.pc1, pcs.pc2)[0, 1]) < 1e-9
    assert [c for c, _ in L.importance(blobs, ["x", "y"])] and L.importance(blobs, ["x", "y"])[0][1] == pytest.approx(np.abs(parts).sum(0).max())


@pytest.mark.parametrize("kind", ["kmeans", "bisecting"])
def test_clusters_find_the_blobs(blobs, kind):
    model = L.fit_clusters(blobs, ["x", "y"], 3, kind)
    got = L.apply_clusters(model, blobs, ["x", "y"])
    assert got.columns == ["k", "x", "y", "cluster"]
    assert sorted(r["count"] for r in got.groupBy("cluster").count().collect()) == [60, 60, 60]
    assert S.agreement(got.withColumn("own", F.floor(F.col("k") / 60)), "own", "cluster").first()["ari"] == pytest.approx(1)


def test_elbow_prefers_three(blobs):
    got = L.elbow(blobs, ["x", "y"], [2, 3, 5]).set_index("k")
    assert got.silhouette.idxmax() == 3 and got.inertia.is_monotonic_decreasing and got.smallest[3] == got.largest[3] == 60


def test_dbscan_equals_brute_force(spark, blobs, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    rows = blobs.select("k", "x", "y").toPandas()
    rows.loc[len(rows)] = [900, 30.0, 30.0]
    at = rows[["x", "y"]].to_numpy()
    near = ((at[:, None] - at[None]) ** 2).sum(2) <= 0.5**2
    core = near.sum(1) >= 5
    label = {i: i for i in np.flatnonzero(core)}
    while True:
        new = {i: min(label[j] for j in label if near[i, j]) for i in label}
        if new == label:
            break
        label = new
    key = rows.k.astype(int).tolist()
    want = {key[i]: min((key[label[j]] for j in label if near[i, j]), default=None) for i in range(len(rows))}
    got = {r["k"]: r["cluster"] for r in L.dbscan(spark.createDataFrame(rows.astype({"k": int})), "k", ["x", "y"], 0.5, 5).collect()}
    assert got == want and want[900] is None


def test_attached_labels_take_the_bin(spark):
    events = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c")], "u int, bin int, e string")
    labels = spark.createDataFrame([(1, 0, 5), (1, 0, 4), (2, 0, 7)], "u int, bin int, cluster int")
    assert sorted((r["e"], r["cluster"]) for r in L.attach_labels(events, labels, ["u", "bin"]).collect()) == [("a", 4), ("c", 7)]


def test_to_normal_is_symmetric(spark):
    got = {r["x"]: r["z"] for r in L.to_normal(spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 5)] + [(None,)], "x double"), "x", "z").collect()}
    assert got[3.0] == pytest.approx(0, abs=1e-9) and got[2.0] == pytest.approx(-got[4.0]) and got[5.0] == pytest.approx(5.199, abs=1e-3) and got[None] is None


def test_bootstrap_interval_covers_the_mean(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(10, 2, 400)
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(x)] + [("b", 0, 3.0)], "g string, k int, x double")
    got = {r["g"]: r for r in G.bootstrap_ci(df, ["g"], "x", F.concat_ws("|", "g", "k"), 200).collect()}
    half = 1.96 * x.std() / 20
    assert got["a"]["lower"] == pytest.approx(x.mean() - half, abs=0.08) and got["a"]["upper"] == pytest.approx(x.mean() + half, abs=0.08)
    assert (got["b"]["lower"], got["b"]["mean"], got["b"]["upper"]) == (3.0, 3.0, 3.0)


def test_last_ranges_are_clipped(spark):
    from datetime import date, timedelta

    df = spark.createDataFrame([(date(2024, 1, 1) + timedelta(days=i),) for i in range(20)], "d date")
    assert G.last_ranges(df, "d") == [(date(2024, 1, 1), date(2024, 1, 6)), (date(2024, 1, 7), date(2024, 1, 20))]
    assert G.last_ranges(df.limit(0), "d") == []


def test_moments_leave_out_infinities(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("inf")), ("a", 3.0), ("a", float("nan")), ("b", 2.0)], "g string, x double")
    (row,) = S.moments(df, ["x"], ["g"]).collect()
    assert (row["g"], row["n"], row["mean"]) == ("a", 2, 2.0)


def test_empty_columns_go_and_group_filters(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None)], "k int, n int, p string")
    assert P.without_empty_columns(df).columns == ["k", "p"]
    known = {"A": "a", "B": "b"}
    assert df.where(P.group_filter(F.col("p"), known, ("Default",))).count() == 1
    assert df.where(P.group_filter(F.col("p"), known, ("A", "B", "Default"))).count() == 2
    assert df.where(P.group_filter(F.col("p"), {}, ("Default",))).count() == 2


def test_risk_flags_need_score_and_profit(spark):
    df = spark.createDataFrame([(i, float(i), float(100 - i)) for i in range(100)], "k int, x double, profit double")
    got = L.risk_score(df, {"x": 1.0}, {"x": 1.0}, 0.0, F.col("profit"), 5.0).toPandas().set_index("k")
    assert got.is_risk_score.sum() == 10 and got.is_risk.sum() == 6 and got.linear_score[99] == 1.0
