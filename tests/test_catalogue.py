import os

import pytest

import __spark_entry__
import oracle_check

SF = "/root/testdata/sf0.001"
SAMPLE = ["a1_csv_scan", "a6_training_batches", "b13_cross_series_median", "c9_clean_text", "c15_encode_pairs", "d6_design_matrix", "e1_group_aggregate",
          "e14_outliers", "f1_group_size", "f13_best_lag", "g5_asof_by_key", "g7_group_lookup_fallback", "g11_nearest_neighbors", "h2_wide_to_long",
          "k3_stratified_folds", "m10_event_study", "m12_gap_fill", "m15_national_matrix", "j16_passenger_raw_view", "j17_row_features",
          "n4_roc_auc", "n8_chi_square", "n8_chi_square_yates", "n14_numeric_drift", "l22_threshold_sweep", "l24_batch_scoring", "p3_user_aggregate",
          "k4_stratified_group_folds", "k6_bagged_scores", "l10_naive_bayes", "l19_two_day_recursion", "m5_cross_correlation_by_series", "o4_online_lags"]
ALL = sorted(__spark_entry__.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return oracle_check.duck(SF)


@pytest.mark.parametrize("name", ALL if os.environ.get("ALL_PLANS") else SAMPLE)
def test_plan_equals_oracle(spark, con, name):
    df = __spark_entry__.queries()[name](spark, SF)
    assert oracle_check.compare(df, con, __spark_entry__.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_oracle_has_a_plan():
    assert set(ALL) <= set(__spark_entry__.queries())


def test_recursive_forecast_is_whole_and_not_negative(spark):
    out = __spark_entry__.queries()["l19_recursive_horizon"](spark, SF).toPandas()
    assert len(out) == out["series"].nunique() * 16 and (out["forecast"] >= 0).all()
    assert out.groupby("series")["day"].nunique().eq(16).all()


def test_out_of_fold_scores_hold_every_row_once(spark):
    out = __spark_entry__.queries()["k7_out_of_fold_scores"](spark, SF).toPandas()
    assert out["c_custkey"].is_unique and len(out) == spark.read.parquet(f"{SF}/customer.parquet").count()
    assert out[["s_logistic", "s_tree"]].stack().between(0, 1).all()
