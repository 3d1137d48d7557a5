import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from panelwright.operators import scale


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    n = 600
    pdf = pd.DataFrame({"id": np.arange(n), "k": np.where(rng.random(n) < 0.4, "hot", rng.integers(0, 9, n).astype(str)),
                        "v": np.round(rng.exponential(10, n), 1)})
    pdf.loc[::17, "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None)))
    return pdf, df


@pytest.mark.parametrize("parts", [1, 7])
def test_exact_quantiles_match_numpy(rows, parts):
    pdf, df = rows
    probs = [0, 0.1, 0.5, 0.77, 1]
    got = {(r["k"], i): r[f"q{i}"] for r in scale.exact_quantiles(df.repartition(parts), ["v"], probs, ["k"]).collect() for i in range(5)}
    for k, g in pdf.dropna().groupby("k"):
        assert np.allclose([got[k, i] for i in range(5)], np.quantile(g["v"], probs))


def test_quantiles_of_one_value_and_of_nothing(spark):
    df = spark.createDataFrame([(1.5,), (None,)], "v double")
    assert scale.quantile_values(df, ["v"], [0.0, 0.5]) == {"v": [1.5, 1.5]}
    assert scale.quantile_values(df.where("v is null"), ["v"], [0.5]) == {"v": []}


def test_group_stats_with_hot_keys_and_null_keys(rows, monkeypatch):
    pdf, df = rows
    df = df.withColumn("k", F.when(F.col("id") % 50 != 0, F.col("k")))
    monkeypatch.setattr(scale, "FAN", 5)
    out = scale.with_group_stats(df, ["k"], {"n": F.count(F.lit(1)), "m": F.avg("v")}, ["id"], hot_rows=20)
    got = {r["id"]: (r["n"], r["m"]) for r in out.collect()}
    assert len(got) == len(pdf)
    masked = pdf.assign(k=pdf["k"].where(pdf["id"] % 50 != 0))
    n = masked.groupby("k")["id"].transform("size")
    m = masked.groupby("k")["v"].transform("mean")
    for i in masked["id"]:
        if i % 50 == 0:
            assert got[i] == (None, None)
        else:
            assert got[i][0] == n[i] and got[i][1] == pytest.approx(m[i])


def test_average_ranks_match_pandas(rows, monkeypatch):
    monkeypatch.setattr(scale, "HOT_ROWS", 10)
    pdf, df = rows
    got = {r["id"]: r["r"] for r in scale.average_ranks(df, "v", "r", ["k"], ["id"]).collect()}
    want = pdf.groupby("k")["v"].rank()
    assert len(got) == len(pdf)
    for i, w in want.items():
        assert got[i] is None if np.isnan(w) else got[i] == w


def test_running_totals_do_not_depend_on_the_edges(rows):
    _, df = rows
    freq = df.where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    base = sorted(map(tuple, scale.running_totals(freq, "v", ["n"], edges=[]).collect()))
    assert base == sorted(map(tuple, scale.running_totals(freq, "v", ["n"], edges=[1.0, 3.3, 40.0]).collect()))
    assert base == sorted(map(tuple, scale.running_totals(freq, "v", ["n"]).collect()))


def test_range_index_counts_edges_below(spark):
    edges = [1.0, 2.0, 5.0]
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (5.0,), (6.0,)], "v double")
    assert [r[0] for r in df.select(scale.range_index(F.col("v"), edges)).collect()] == [0, 0, 1, 2, 3]


def test_hash_numbering_equals_a_plain_window_and_keeps_null_keys(rows):
    _, df = rows
    df = df.withColumn("k", F.when(F.col("id") % 9 != 0, F.col("k")))
    got = {r["id"]: r["no"] for r in scale.numbered_by_hash(df.repartition(5), ["id"], ["k"], 3, "no").collect()}
    w = Window.partitionBy("k").orderBy(scale.hash_key("id", seed=3), "id")
    want = {r["id"]: r["no"] for r in df.withColumn("no", F.row_number().over(w)).collect()}
    assert got == want


def test_hot_keys_are_cut_by_their_own_edges(spark, monkeypatch):
    monkeypatch.setattr(scale, "HOT_VALUES", 50)
    rows = [("hot", i * 0.001) for i in range(3000)] + [("far", 1e6 + i) for i in range(100)] + [(f"k{i % 40}", float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, v double")
    cut = scale._with_range(df, "v", ["k"]).groupBy("k").agg(F.count_distinct("_range").alias("n")).collect()
    n = {r["k"]: r["n"] for r in cut}
    assert n["hot"] >= 4 and n["far"] >= 4 and n["k1"] == 1
    got = {r["k"]: r["q0"] for r in scale.exact_quantiles(df, ["v"], [0.5], ["k"]).collect()}
    assert abs(got["hot"] - 1.4995) < 1e-9 and abs(got["far"] - (1e6 + 49.5)) < 1e-9


def test_many_edges_give_the_same_ranges(spark):
    edges = [i / 7 for i in range(300)]
    df = spark.createDataFrame([(i / 3,) for i in range(-3, 200)], "v double")
    want = [sum(e < r["v"] for e in edges) for r in df.collect()]
    assert [r[0] for r in df.select(scale.range_index(F.col("v"), edges)).collect()] == want
