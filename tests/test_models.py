import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from panelwright.features.steps import assemble
from panelwright.models import zoo as Z
from panelwright.models.ridge import ManyTargetRidge
from panelwright.operators import metrics as M
from panelwright.operators.neighbors import nearest_neighbors


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"y": rng.integers(0, 2, 300), "s": np.round(rng.random(300), 1)})
    return pdf, spark.createDataFrame(pdf)


def test_auc_and_average_precision_with_ties(scores):
    pdf, df = scores
    pos, neg = pdf[pdf.y == 1].s.to_numpy(), pdf[pdf.y == 0].s.to_numpy()
    auc = ((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg)).mean()
    assert M.roc_auc(df, "y", "s").first()[0] == pytest.approx(auc)
    ap, last = 0.0, 0.0
    for t in sorted(pdf.s.unique(), reverse=True):
        called = pdf[pdf.s >= t]
        recall = called.y.sum() / pdf.y.sum()
        ap, last = ap + (recall - last) * called.y.mean(), recall
    assert M.average_precision(df, "y", "s").first()[0] == pytest.approx(ap)


def test_sweep_matches_brute_force(scores):
    pdf, df = scores
    for r in M.threshold_sweep(df, "y", "s", steps=37).collect():
        assert r["accuracy"] == pytest.approx(((pdf.s >= r["threshold"]) == (pdf.y == 1)).mean())


def test_chi_square_tail():
    for x, dof, p in ((3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (18.307038053275146, 10, 0.05), (0.0, 3, 1.0)):
        assert M.chi2_tail(x, dof) == pytest.approx(p, rel=1e-9)


def test_ridge_matches_the_closed_form(spark):
    rng = np.random.default_rng(5)
    days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(40)]
    x = rng.normal(size=(40, 3))
    y = {s: x @ rng.normal(size=3) + rng.normal(size=40) + 7 for s in "ab"}
    design = spark.createDataFrame([(d, *map(float, r)) for d, r in zip(days, x)], "day date, x0 double, x1 double, x2 double")
    panel = spark.createDataFrame([(s, d, float(v)) for s in y for d, v in zip(days, y[s])], "s string, day date, v double")
    model = ManyTargetRidge(["s"], "v", ["x0", "x1", "x2"]).fit(panel, design)
    z = (x - x.mean(0)) / x.std(0)
    for r in model.coefficients([0.5, 3.0]).collect():
        want = np.linalg.solve(z.T @ z + r["alpha"] * np.eye(3), z.T @ y[r["s"]])
        assert np.allclose(r["coef"], want) and r["intercept"] == pytest.approx(y[r["s"]].mean())
    fitted = model.predict(design, 0.5).toPandas()
    assert len(fitted) == 80 and fitted["baseline"].notna().all()
    with pytest.raises(ValueError):
        ManyTargetRidge(["s"], "v", ["x0"]).fit(panel.limit(79), design)


@pytest.mark.parametrize("tile", [7, 4096])
def test_neighbours_match_brute_force(spark, tile):
    rng = np.random.default_rng(6)
    x = np.vstack([rng.normal(size=(60, 4)), rng.normal(size=(20, 4)) * 0.01 + 9])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    got = nearest_neighbors(df, df, "id", "v", 3, exclude_self=True, tile_rows=tile).toPandas().sort_values(["query_id", "rank"])
    assert (got["neighbor_id"].to_numpy().reshape(-1, 3) == np.argsort(d, axis=1, kind="stable")[:, :3]).all()


def test_attribution_adds_up(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame(rng.normal(size=(30, 3)), columns=["a", "b", "c"]).assign(id=range(30))
    pdf["label"] = 2 * pdf.a - pdf.b + 0.5
    df = spark.createDataFrame(pdf)
    model = LinearRegression().fit(assemble(df, ["a", "b", "c"]))
    values = Z.shapley_values(model, df, ["id"], ["a", "b", "c"], background=1, permutations=3).toPandas()
    total = values.groupby("id")["value"].sum()
    gap = (pdf.label - total.to_numpy()).to_numpy()
    assert len(values) == 90 and np.allclose(gap, gap[0])  # one background row: prediction minus a constant


def test_ridge_with_more_regressors_than_days(spark):
    rng = np.random.default_rng(8)
    days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(60)]
    x = rng.normal(size=(60, 2500))
    y = {s: x[:, :5] @ rng.normal(size=5) + rng.normal(size=60) for s in "abc"}
    wide = spark.createDataFrame([(d, r.tolist()) for d, r in zip(days, x)], "day date, x array<double>")
    names = [f"x{i}" for i in range(2500)]
    design = wide.select("day", *[F.col("x")[i].alias(n) for i, n in enumerate(names)])
    panel = spark.createDataFrame([(s, d, float(v)) for s in y for d, v in zip(days, y[s])], "s string, day date, v double")
    model = ManyTargetRidge(["s"], "v", names).fit(panel, design)
    z = (x - x.mean(0)) / x.std(0)
    for r in model.coefficients([2.0]).collect():
        want = np.linalg.solve(z.T @ z + 2.0 * np.eye(2500), z.T @ y[r["s"]])
        assert np.allclose(r["coef"], want, atol=1e-8)


def test_power_search_leaves_its_first_box(spark):
    from panelwright.functions.expr import fit_power
    rng = np.random.default_rng(9)
    lam = fit_power(spark.createDataFrame(pd.DataFrame({"x": np.power(1 + 4.5 * (0.5 + 0.05 * rng.normal(size=2000)), 1 / 4.5)})), "x")
    assert lam > 2.05


@pytest.mark.parametrize("exclude", [True, False])
def test_tiles_of_copies_and_blocks_match_brute_force(monkeypatch, exclude):
    from panelwright.operators import neighbors as N

    monkeypatch.setattr(N, "BLOCK_CELLS", 3000)
    rng = np.random.default_rng(11)
    x = rng.integers(0, 3, (700, 2)) * 1.1 + 5
    side = pd.DataFrame({"id": np.arange(700)[::-1] // 2, "v": list(x)})
    bad = pd.DataFrame({"id": [900, 901], "v": [np.array([np.nan, 1.0]), np.array([np.inf, 1.0])]})
    got = N._tile_top_k(side[::7], pd.concat([side, bad], ignore_index=True), 4, exclude)
    want = []
    for q, v in zip(side["id"][::7], x[::7], strict=True):
        d = np.sqrt(((v - x) ** 2).sum(1))
        order = [j for j in np.lexsort((side["id"], d)) if not (exclude and side["id"][j] == q)][:4]
        want += [(q, side["id"][j], d[j]) for j in order]
    assert sorted(zip(got["query_id"], got["neighbor_id"], got["distance"], strict=True)) == sorted(want)  # copies tie exactly
