import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from panelwright.features import steps as S
from panelwright.features.base import FitError
from panelwright.operators import joins as J, splits as K
from panelwright.functions import expr as X, text as T


def test_right_closed_bins_with_repeated_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (2.1,), (None,)], "v double")
    got = [r[0] for r in df.select(S.bin_right_closed(F.col("v"), [1, 1, 2], default=-1)).collect()]
    assert got == [-1, 0, 0, 0, -1, -1]
    assert [r[0] for r in df.select(S.bin_right_closed(F.col("v"), [0, 1, 2], default=9, include_lowest=False)).collect()] == [9, 0, 1, 1, 9, 9]


def test_zero_aware_and_left_closed_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (4.0,), (80.0,), (None,)], "v double")
    assert [r[0] for r in df.select(S.zero_aware_bin(F.col("v"), [1, 2, 4])).collect()] == [0, 1, 2, -1, 0]
    assert [r[0] for r in df.select(S.bin_left_closed(F.col("v"), [0, 4, 80], ["lo", "hi"], "Missing")).collect()] == ["lo", "lo", "hi", "Missing", "Missing"]


@pytest.fixture()
def train(spark):
    return spark.createDataFrame([("a", "x", 1.0), ("a", "x", None), ("a", "y", 5.0), ("b", None, 7.0), ("c", "x", 9.0)], "g string, c string, v double")


def test_fit_does_not_see_the_applied_table(spark, train):
    apply = spark.createDataFrame([("a", "z", None), ("q", "y", None), (None, "x", 100.0)], "g string, c string, v double")
    model = Pipeline(stages=[S.GroupMedianImputer(["g"], "v"), S.RareLevelCollapser(["c"], 0.4), S.FrequencyEncoder("g", "n"),
                             S.DomainOneHot(["c"])]).fit(train)
    alone = sorted(map(str, model.transform(apply).collect()))
    more = model.transform(apply.unionByName(apply.withColumn("v", F.lit(-5.0))))
    assert len(alone) == 3 and set(alone) <= {str(r) for r in more.collect()}
    got = {r["g"]: r for r in model.transform(apply).collect()}
    assert got["a"]["v"] == 3.0 and got["q"]["v"] == 6.0 and got[None]["v"] == 100.0
    assert (got["a"]["n"], got["q"]["n"], got[None]["n"]) == (3, 0, 0)
    assert got["q"]["c_Other"] == 1.0 and got[None]["c_x"] == 1.0


def test_saved_pipeline_gives_the_same_rows(spark, train, tmp_path):
    model = Pipeline(stages=[S.SimpleImputer(["v"], ["c"]), S.GroupMedianImputer(["g"], "v"), S.PopulationScaler(["v"])]).fit(train)
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert sorted(map(str, again.transform(train).collect())) == sorted(map(str, model.transform(train).collect()))


def test_levels_base_compares_with_the_number_of_levels(train, monkeypatch):
    want = ["Other", "x", "x", "x", "y"]
    model = S.RareLevelCollapser(["c"], 0.5, base="levels").fit(train)
    assert sorted(r["c"] for r in model.transform(train).collect()) == want
    monkeypatch.setattr(S, "MAX_LEVELS", 1)
    table = S.RareLevelCollapser(["c"], 0.5, base="levels").fit(train)
    assert list(table.tables) == ["c"] and sorted(r["c"] for r in table.transform(train).collect()) == want


def test_empty_fits_and_wide_domains_are_refused(train, monkeypatch):
    with pytest.raises(FitError):
        S.SimpleImputer(["v"]).fit(train.where("v is null"))
    monkeypatch.setattr(S, "MAX_LEVELS", 1)
    with pytest.raises(FitError):
        S.DomainOneHot(["c"]).fit(train)


def test_scaler_leaves_constant_columns_alone(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "a double, b double")
    got = S.PopulationScaler(["a", "b"]).fit(df).transform(df).collect()
    assert [tuple(r) for r in got] == [(0.0, -1.0), (0.0, 1.0)]


def test_many_to_one_join_refuses_duplicates(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(J.DuplicateKeysError):
        J.join_many_to_one(left, right, ["k"])


def test_key_match_lists_known_keys(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    assert X.match_key(df, "k", "2").count() == 1
    with pytest.raises(KeyError, match="Available"):
        X.match_key(df, "k", "7")


def test_folds_are_balanced_disjoint_and_partition_free(spark):
    df = spark.range(101).withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    one = {r["id"]: r["fold"] for r in K.stratified_folds(df.repartition(1), ["id"], "y", 5).collect()}
    many = {r["id"]: r["fold"] for r in K.stratified_folds(df.repartition(9), ["id"], "y", 5).collect()}
    assert one == many and len(one) == 101
    counts = np.bincount([f for i, f in one.items() if i % 3 == 0])
    assert counts.max() - counts.min() <= 1


def test_cleaner_and_tokens(spark):
    df = spark.createDataFrame([("  Hi @Bob_1 see HTTPS://x.y/z?q and www.a.b \n ok ! ",), ("   ",), (None,)], "t string")
    assert [r[0] for r in df.select(T.clean_text(F.col("t"))).collect()] == ["hi see and ok !", "", None]
    assert [r[0] for r in df.select(F.size(T.words(F.col("t")))).collect()] == [8, 0, 0]
    toks = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    assert [r[0] for r in toks.select(T.ngrams(F.col("t"), 1, 3)).collect()] == [["a", "b", "c", "a b", "b c", "a b c"], ["a"], []]


def test_sparse_one_hot_takes_any_number_of_levels(spark):
    from panelwright.features.steps import SparseOneHot
    df = spark.range(7000).selectExpr("id", "concat('level ', id) AS c")
    model = SparseOneHot("c", "v").fit(df)
    rows = model.transform(df.union(spark.createDataFrame([(-1, "unseen"), (-2, None)], "id long, c string"))).collect()
    seen = [r for r in rows if r["id"] >= 0]
    assert {r["v"].size for r in rows} == {7000} and {r["v"].numNonzeros() for r in seen} == {1}
    assert len({int(r["v"].indices[0]) for r in seen}) == 7000
    assert all(r["v"].numNonzeros() == 0 for r in rows if r["id"] < 0)
