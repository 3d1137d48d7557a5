import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwright.operators import panel as P, series as S

D = dt.date


def frame(spark, rows):
    return spark.createDataFrame(rows, "s string, day date, v double")


def test_dense_grid_inserts_days_over_a_leap_day(spark):
    df = frame(spark, [("a", D(2024, 2, 27), 1.0), ("a", D(2024, 3, 1), 2.0), ("b", D(2024, 2, 28), 5.0)])
    got = sorted((r["s"], r["day"], r["v"]) for r in P.dense_daily(df, ["s"]).collect())
    assert got == [("a", D(2024, 2, 27), 1.0), ("a", D(2024, 2, 28), None), ("a", D(2024, 2, 29), None), ("a", D(2024, 3, 1), 2.0), ("b", D(2024, 2, 28), 5.0)]
    assert P.dense_daily(df, ["s"], shared_calendar=True).count() == 8


def test_fill_gaps(spark):
    days = [D(2024, 1, 1) + dt.timedelta(i) for i in range(16)]
    rows = [("x", d, None if i in (0, 7, 9, 15) else float(i)) for i, d in enumerate(days)]
    rows += [("none", d, None) for d in days[:3]] + [("one", days[0], 4.0)]
    got = {(r["s"], r["day"]): r["v"] for r in P.fill_gaps(frame(spark, rows), ["s"], "v").collect()}
    assert got["x", days[0]] == 0.0 and got["x", days[15]] == 0.0
    assert got["x", days[7]] == 14.0  # the only other Monday inside
    assert got["x", days[9]] == 2.0
    assert all(got["none", d] == 0.0 for d in days[:3]) and got["one", days[0]] == 4.0


def test_forward_sum_tail_and_start_flag(spark):
    days = [D(2024, 1, 1) + dt.timedelta(i) for i in range(5)]
    df = frame(spark, [("a", d, float(v)) for d, v in zip(days, (1, 0, 1, 1, 0))])
    out = df.select("day", P.forward_sum("v", 0, 2, ["s"]).alias("f"), P.forward_sum("v", 3, 4, ["s"]).alias("g"), P.start_flag("v", ["s"]).alias("b")).orderBy("day").collect()
    assert [r["f"] for r in out] == [2.0, 2.0, 2.0, 1.0, 0.0]
    assert [r["g"] for r in out] == [1.0, 0.0, None, None, None]
    assert [r["b"] for r in out] == [False, False, True, False, False]


def test_thinning_is_greedy(spark):
    days = [D(2024, 1, d) for d in (1, 3, 7, 8, 15, 16, 30)]
    got = sorted(r["day"] for r in P.thin_by_gap(frame(spark, [("a", d, 1.0) for d in days + days]), ["s"], "day", 7).collect())
    assert got == [D(2024, 1, 1), D(2024, 1, 8), D(2024, 1, 15), D(2024, 1, 30)]


@pytest.mark.parametrize("edges", [None, [], [86400.0 * 19725, 86400.0 * 19740]])
def test_asof_matches_pandas(spark, edges):
    rng = np.random.default_rng(1)
    day = lambda n: pd.to_datetime("2024-01-01") + pd.to_timedelta(rng.integers(0, 40, n), unit="D")
    left = pd.DataFrame({"id": range(200), "k": rng.choice(["a", "b", "c"], 200), "t": day(200)})
    right = pd.DataFrame({"k": rng.choice(["a", "b"], 30), "t": day(30), "v": rng.random(30)}).drop_duplicates(["k", "t"])
    want = pd.merge_asof(left.sort_values("t"), right.sort_values("t"), on="t", by="k").set_index("id")["v"]
    l = spark.createDataFrame(left).withColumn("t", F.to_date("t"))
    r = spark.createDataFrame(right).withColumn("t", F.to_date("t"))
    got = {x["id"]: x["v"] for x in P.asof_backward(l, r, ["k"], "t", "t", ["v"], edges).collect()}
    assert len(got) == 200
    for i, v in want.items():
        assert got[i] is None if np.isnan(v) else got[i] == v


def test_zscore_of_a_constant_series_is_null(spark):
    df = frame(spark, [("a", D(2024, 1, 1), 3.0), ("a", D(2024, 1, 2), 3.0), ("b", D(2024, 1, 1), 1.0), ("b", D(2024, 1, 2), 3.0)])
    got = {(r["s"], r["day"].day): r["v"] for r in P.zscore(df, ["s"], ["v"]).collect()}
    assert got == {("a", 1): None, ("a", 2): None, ("b", 1): -1.0, ("b", 2): 1.0}


@pytest.fixture(scope="module")
def wave(spark):
    rng = np.random.default_rng(2)
    x = np.zeros(120)
    for t in range(2, 120):
        x[t] = 0.6 * x[t - 1] - 0.3 * x[t - 2] + rng.normal()
    return x, frame(spark, [("a", D(2024, 1, 1) + dt.timedelta(i), float(v)) for i, v in enumerate(x)])


def test_periodogram_keeps_the_variance(wave):
    x, df = wave
    out = S.periodogram(df, ["s"], "v", detrend="constant").toPandas()
    assert len(out) == 61 and out["power"].sum() == pytest.approx(x.var())


def test_partial_autocorrelations_solve_yule_walker(wave):
    x, df = wave
    z = x - x.mean()
    r = np.array([(z[k:] * z[:len(z) - k]).sum() for k in range(6)]) / (z * z).sum()
    want = []
    for p in range(1, 6):
        m = np.array([[r[abs(i - j)] for j in range(p)] for i in range(p)])
        want.append(np.linalg.solve(m, r[1:p + 1])[-1])
    got = S.partial_autocorrelations(df, ["s"], "v", 5).orderBy("lag").toPandas()["pacf"]
    assert np.allclose(got, want)


def test_ar_order_by_aic(wave, spark):
    x, df = wave
    best = None
    for p in range(1, 5):
        y, m = x[p:], np.stack([x[p - k:len(x) - k] for k in range(1, p + 1)], 1)
        phi = np.linalg.lstsq(m, y, rcond=None)[0]
        s2 = ((y - m @ phi) ** 2).mean()
        aic = len(y) * (np.log(2 * np.pi) + np.log(s2) + 1) + 2 * (p + 1)
        if best is None or aic < best[0]:
            best = (aic, phi)
    got = S.fit_ar(df, ["s"], "v", 4).first()["phi"]
    assert np.allclose(got, best[1], atol=1e-6)
    flat = frame(spark, [("z", D(2024, 1, 1) + dt.timedelta(i), 0.0) for i in range(9)])
    assert S.fit_ar(flat, ["s"], "v", 3).first()["phi"] == []


def test_constant_side_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 9.0)], "x double, y double")
    assert df.agg(S.guarded_corr(F.col("x"), F.col("y"))).first()[0] is None
