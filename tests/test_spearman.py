import numpy as np
import pandas as pd

from panelwright.operators import reshape as R


def test_rank_matrix_of_few_and_many_values_matches_pandas(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"id": range(400), "few": rng.integers(0, 5, 400).astype(float), "many": rng.normal(size=400), "one": 1.0})
    pdf["both"] = pdf["many"] + pdf["few"].round(1)
    pdf["five"] = -pdf["few"]
    rows = [tuple(None if k % 40 == 0 and j == 1 else float(v) if j else int(v) for j, v in enumerate(r)) for k, r in enumerate(pdf.itertuples(index=False))]
    df = spark.createDataFrame(rows, "id long, few double, many double, one double, both double, five double")
    names = ["few", "many", "one", "both", "five"]
    want = pdf[pdf.index % 40 != 0][names].corr("spearman")
    got = {(r["a"], r["b"]): r["rho"] for r in R.spearman_matrix(df, names, ["id"]).collect()}
    assert len(got) == 10
    for (a, b), rho in got.items():
        assert rho is None if "one" in (a, b) else abs(rho - want.loc[a, b]) < 1e-9


def test_columns_of_few_values_stay_out_of_the_long_rows(spark):
    df = spark.range(300).selectExpr("id", "id % 7 a", "id % 5 b", "id % 200 c")
    plan = lambda cols: R.spearman_matrix(df, cols, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan(["a", "b"]) and "Join" in plan(["a", "b", "c"])
