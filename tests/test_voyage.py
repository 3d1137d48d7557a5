import re

import pytest
from pyspark.sql import functions as F

from panelwright.features import steps as S
from panelwright.features.voyage import GroupSpendFeaturizer
from panelwright.operators import scale


def voyagers(spark):
    i = F.col("id")
    return spark.range(60).select(
        F.when(i != 7, F.concat_ws("_", (i % 17).cast("string"), i.cast("string"))).alias("PassengerId"),
        F.when(i % 5 != 0, F.concat(F.lit("H"), (i % 3).cast("string"))).alias("HomePlanet"), F.lit("D0").alias("Destination"),
        F.when(i % 4 != 0, i % 2 == 0).alias("CryoSleep"), F.when(i % 6 != 0, i % 3 == 0).alias("VIP"),
        F.when(i % 7 != 0, F.concat_ws("/", F.lit("B"), (i * 31 % 900).cast("string"), F.lit("P"))).alias("Cabin"),
        F.when(i % 3 != 0, (i * 7 % 80).cast("double")).alias("Age"), F.when(i % 8 != 0, (i % 9).cast("double")).alias("RoomService"),
        *[(i % k).cast("double").alias(c) for c, k in (("FoodCourt", 4), ("ShoppingMall", 5), ("Spa", 6))], F.lit(0.0).alias("VRDeck"),
        F.when(i % 9 != 0, F.concat(F.lit("Ann Sur"), (i % 4).cast("string"))).alias("Name"))


def method_size(df) -> int:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled")
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = df.select("*")._jdf.queryExecution().explainString(mode)
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", adaptive)
    return max([int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)], default=0)


@pytest.mark.parametrize("fixed", [True, False])
def test_fitted_rows_are_neither_parsed_nor_grouped_again(spark, fixed):
    df = voyagers(spark)
    model, rows = GroupSpendFeaturizer(use_fixed_group_bins=fixed).fit_rows(df)
    once, again = model.raw_from_grouped(rows), model.raw_view(df)
    assert once.columns == again.columns and sorted(map(str, once.collect())) == sorted(map(str, again.collect()))
    matrix = model.matrix(once)
    assert matrix.columns == model.transform(df).columns and sorted(map(str, matrix.collect())) == sorted(map(str, model.transform(df).collect()))
    assert "regexp_extract" not in matrix._jdf.queryExecution().optimizedPlan().toString()


def test_only_crowded_groups_are_cut_into_ranges(spark, monkeypatch):
    rows = [(k, float(v)) for k, n in (("a", 3), ("b", 40), ("c", 1)) for v in range(n)] + [("a", None), (None, 5.0), ("d", None), ("c", -0.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    for hot in (65_536, 20):
        monkeypatch.setattr(scale, "HOT_VALUES", hot)
        out = scale.exact_quantiles(df, ["v"], [0.0, 0.25, 1.0], ["k"])
        got = {r["k"]: (r["n_values"], r["q0"], r["q1"], r["q2"]) for r in out.collect()}
        assert got == {"a": (3, 0.0, 0.5, 2.0), "b": (40, 0.0, 9.75, 39.0), "c": (2, 0.0, 0.0, 0.0)} and "-" not in str(got["c"])
        ran = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert ("_range" in ran) == (hot == 20)


def test_many_bins_and_levels_stay_within_compiled_methods(spark):
    numbers = spark.range(50).select(*[(F.col("id") * (i + 1) % 50).cast("double").alias(f"v{i}") for i in range(40)])
    edges = [0, 7, 14, 21, 28, 35, 49]
    assert method_size(numbers.repartition(2).select(*[S.bin_right_closed(F.col(c), edges, default=-1).alias(c) for c in numbers.columns])) < 8_000
    texts = spark.range(50).select(*[(F.col("id") % 10).cast("string").alias(f"t{i}") for i in range(9)])
    hot = S.DomainOneHot(texts.columns).fit(texts).transform(texts.repartition(2))
    assert len(hot.columns) == 90 and method_size(hot) < 8_000


def test_bins_hold_their_upper_edge(spark):
    df = spark.createDataFrame([(v,) for v in (None, float("nan"), -1.0, 0.0, 0.5, 1.0, 1.5, 4.0, 4.1)], "v double")
    closed, opened = S.bin_right_closed(F.col("v"), [0, 1, 1, 4], default=-1), S.bin_right_closed(F.col("v"), [0, 1, 4], default=9, include_lowest=False)
    assert [tuple(r) for r in df.select(closed, opened).collect()] == [
        (-1, 9), (-1, 9), (-1, 9), (0, 9), (0, 0), (0, 0), (1, 1), (1, 1), (-1, 9)]
    with pytest.raises(ValueError):
        S.bin_right_closed(F.col("v"), [0, 1, 1, 4], ["x", "y", "z"])
