"""Model fitting, search, combination, scoring and attribution plans."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes, OneVsRest, RandomForestClassifier)
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from panelwright.features.steps import assemble, positive_probability
from panelwright.functions.text import english_stop_words
from panelwright.models import forecast as FC, scoring as SC, zoo as Z
from panelwright.models.ridge import ManyTargetRidge, log_grid
from panelwright.operators import user as U
from panelwright.operators.neighbors import nearest_neighbors, vote
from panelwright.operators.splits import group_fold, holdout, stratified_folds, uniform
from panelwright.plans.panels import KEYS, PANEL_SQL, dense_panel, driver, promotions
from panelwright.plans.registry import day_text, plan, rounded
from panelwright.plans.text import PAIRS_SQL, conversation_pairs
from panelwright.sources.scratch import materialize
from panelwright.sources.tables import scan, spread

CUSTOMER_FEATURES = ["c_acctbal", "c_nationkey", "n_orders"]
PART_FEATURES = ["p_size", "p_lot", "p_brand_no", "p_serial"]


def labelled_customers(spark, sf):
    """Customers with order counts; the label follows the balance, with hashed noise; 3 folds."""
    orders = scan(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    noise = uniform("c_custkey", seed="noise") < 0.1
    rows = scan(spark, sf, "customer").join(orders, "c_custkey", "left").na.fill(0, ["n_orders"]).select(
        "c_custkey", *CUSTOMER_FEATURES, ((F.col("c_acctbal") > 5000) != noise).cast("double").alias("label"),
        group_fold(["c_custkey"], 3, 5).alias("fold"))
    return materialize(assemble(rows, CUSTOMER_FEATURES), "customers")


def priced_parts(spark, sf):
    rows = scan(spark, sf, "part").select(
        "p_partkey", "p_size", (F.col("p_partkey") % 50).alias("p_lot"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("")).cast("int").alias("p_brand_no"), F.col("p_partkey").cast("double").alias("p_serial"),
        (F.col("p_retailprice") / 10 + F.col("p_size") * 2).alias("label"), group_fold(["p_partkey"], 3, 5).alias("fold"),
        holdout(["p_partkey"], 0.2, 9).alias("is_valid"))
    return materialize(assemble(rows, PART_FEATURES), "parts")


def labelled_vectors(spark, sf):
    return materialize(scan(spark, sf, "embeddings").select(
        "vec_id", "embedding", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        holdout(["vec_id"], 0.3, 3).alias("is_valid")), "vectors")


def labelled_documents(spark, sf):
    rows = scan(spark, sf, "documents").join(scan(spark, sf, "labels"), "doc_id").select(
        "doc_id", "text", F.col("quality").cast("double").alias("label"), "quality")
    return materialize(spread(stratified_folds(rows, ["doc_id"], "quality", 2, 1)), "documents")


# --- panels ------------------------------------------------------------------------------

def full_panel(spark, sf):
    """Dense on the shared calendar, zero where nothing was observed."""
    from panelwright.operators.panel import dense_daily
    from panelwright.plans.panels import observed_panel
    return dense_daily(observed_panel(spark, sf), KEYS, shared_calendar=True).na.fill(0.0, ["v"])


FULL_SQL = """d AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS v FROM orders GROUP BY ALL),
cal AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day, min(day) AS lo FROM d),
fp AS (SELECT s.series, cal.day, CAST(cal.day - lo + 1 AS DOUBLE) AS t, coalesce(v, 0) AS v FROM (SELECT DISTINCT series FROM d) s CROSS JOIN cal LEFT JOIN d ON d.series = s.series AND d.day = cal.day)"""


def design_for(panel, order=1):
    first, last = FC.K.day_bounds(panel, "day")
    return FC.day_design(FC.calendar_days(panel, first, last), first, order=order, freq="A", fourier_order=2), first, last


@plan("l1_ridge_one_regressor", f"""
WITH {FULL_SQL}, c AS (SELECT series, regr_slope(v, t) * count(*) / (count(*) + 50.0) AS b, avg(v) AS m, avg(t) AS mt FROM fp GROUP BY series)
SELECT series, 'trend' AS term, round(b, 4) + 0.0 AS coefficient FROM c UNION ALL SELECT series, 'intercept', round(m - b * mt, 2) + 0.0 FROM c""")
def ridge_one(spark, sf):
    panel = materialize(full_panel(spark, sf), "panel")
    design, _, _ = design_for(panel)
    out = ManyTargetRidge(KEYS, "v", ["trend"]).fit(panel, design.select("day", "trend")).named_coefficients(50.0)
    value = F.when(F.col("term") == "trend", rounded("coefficient")).otherwise(rounded("coefficient", 2))
    return out.select("series", "term", value.alias("coefficient"))


@plan("l1_many_target_ridge")
def many_target(spark, sf):
    panel = materialize(full_panel(spark, sf), "panel")
    design, _, _ = design_for(panel, order=2)
    names = [c for c in design.columns if c != "day"]
    model = ManyTargetRidge(KEYS, "v", names, [n for n in names if not n.startswith("s_")]).fit(panel, design)
    return model.predict(design, 10.0)


@plan("l2_penalty_search")
def penalty_search(spark, sf):
    panel = materialize(full_panel(spark, sf), "panel")
    design, _, last = design_for(panel, order=2)
    cut = F.lit(last - dt.timedelta(180))
    names = [c for c in design.columns if c != "day"]
    model = ManyTargetRidge(KEYS, "v", names).fit(panel.where(F.col("day") <= cut), design.where(F.col("day") <= cut))
    return model.search(panel.where(F.col("day") > cut), design.where(F.col("day") > cut), log_grid(1e-2, 1e3, 11))


@plan("l3_ordinary_least_squares", """
SELECT round(regr_slope(p_retailprice, p_size), 6) + 0.0 AS slope, round(regr_intercept(p_retailprice, p_size), 4) + 0.0 AS intercept, count(*) AS n FROM part""")
def ols(spark, sf):
    rows = assemble(scan(spark, sf, "part").select("p_size", "p_retailprice"), ["p_size"])
    m = LinearRegression(labelCol="p_retailprice", solver="normal").fit(rows)
    return rows.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(round(m.coefficients[0], 6)).alias("slope"), F.lit(round(m.intercept, 4)).alias("intercept"), "n")


@plan("l3_penalised_regression_search")
def penalised(spark, sf):
    df, lr = priced_parts(spark, sf), LinearRegression(maxIter=50)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.01, 0.1]).addGrid(lr.elasticNetParam, [0.0, 0.5, 1.0]).build()
    return Z.search_table(Z.grid_search(lr, grid, df, "fold", Z.regression_rmse(), 3), df)


@plan("l4_decision_tree_search")
def decision_tree(spark, sf):
    df, tree = priced_parts(spark, sf), DecisionTreeRegressor(seed=1)
    grid = ParamGridBuilder().addGrid(tree.maxDepth, [3, 6]).addGrid(tree.minInstancesPerNode, [5, 20]).build()
    return Z.search_table(Z.grid_search(tree, grid, df, "fold", Z.regression_rmse(), 3), df)


def _valid_scores(model, df, key):
    return model.transform(df.where("is_valid")).select(key, "label", "prediction")


@plan("l5_random_forest")
def random_forest(spark, sf):
    df = priced_parts(spark, sf)
    model = RandomForestRegressor(numTrees=15, maxDepth=6, featureSubsetStrategy="onethird", minInstancesPerNode=5, seed=1).fit(df.where("NOT is_valid"))
    return _valid_scores(model, df, "p_partkey")


@plan("l5_random_forest_classifier")
def random_forest_classifier(spark, sf):
    df = labelled_customers(spark, sf)
    return Z.out_of_fold(df, "fold", 3, RandomForestClassifier(numTrees=10, maxDepth=5, seed=1).fit,
                         lambda s: s.select("c_custkey", "label", "prediction", positive_probability().alias("score")))


@plan("l6_boosted_tree_regressor")
def boosted_regressor(spark, sf):
    df = priced_parts(spark, sf)
    model = GBTRegressor(maxIter=20, maxDepth=4, stepSize=0.2, subsamplingRate=0.8, validationIndicatorCol="is_valid", seed=1).fit(df)
    return _valid_scores(model, df, "p_partkey")


@plan("l7_boosted_tree_classifier")
def boosted_classifier(spark, sf):
    df, gbt = labelled_customers(spark, sf), GBTClassifier(maxIter=8, seed=1)
    grid = ParamGridBuilder().addGrid(gbt.maxDepth, [2, 4]).build()
    return Z.search_table(Z.grid_search(gbt, grid, df, "fold", Z.classification_accuracy(), 3), df)


@plan("l8_logistic_regression")
def logistic(spark, sf):
    df = Z.balanced_weights(labelled_vectors(spark, sf), "label")
    model = LogisticRegression(weightCol="weight", regParam=0.01, elasticNetParam=0.2, family="multinomial", maxIter=30).fit(df.where("NOT is_valid"))
    return _valid_scores(model, df, "vec_id")


@plan("l9_linear_svm")
def linear_svm(spark, sf):
    df = labelled_documents(spark, sf)
    weighted = Z.balanced_weights(df, "label")
    chain = Z.text_pipeline("text", english_stop_words(spark), weightCol="weight", maxIter=10, regParam=0.01)
    return Z.out_of_fold(weighted, "fold", 2, chain.fit, lambda s: s.select("doc_id", "label", "prediction"))


@plan("l9_linear_svm_multiclass")
def linear_svm_multiclass(spark, sf):
    df = labelled_vectors(spark, sf)
    return _valid_scores(OneVsRest(classifier=LinearSVC(maxIter=10, regParam=0.01)).fit(df.where("NOT is_valid")), df, "vec_id")


@plan("l13_one_feature_ridge_classifier", """
WITH r AS (SELECT c_custkey, c_acctbal AS x, (c_acctbal > 5000) <> ((CAST(concat('0x', substr(md5(concat_ws(':', 'noise', CAST(c_custkey AS VARCHAR))), 1, 13)) AS BIGINT) / 4503599627370496.0) < 0.1) AS up,
  CAST(concat('0x', substr(md5(concat_ws(':', '5', CAST(c_custkey AS VARCHAR))), 1, 8)) AS BIGINT) % 3 AS fold FROM customer),
t AS (SELECT avg(x) AS mx, avg(CASE WHEN up THEN 1.0 ELSE -1.0 END) AS my, covar_pop(x, CASE WHEN up THEN 1.0 ELSE -1.0 END) * count(*) / (var_pop(x) * count(*) + 50000000.0) AS b FROM r WHERE fold <> 0)
SELECT c_custkey, round(my + b * (x - mx), 6) + 0.0 AS score, CAST(my + b * (x - mx) > 0 AS DOUBLE) AS prediction FROM r, t WHERE fold = 0""")
def ridge_classifier_one(spark, sf):
    df = assemble(labelled_customers(spark, sf).drop("features"), ["c_acctbal"])
    _, predict = Z.ridge_classifier(df.where("fold <> 0"), "features", "label", 50_000_000.0)
    return predict(df.where("fold = 0")).select("c_custkey", rounded("score", 6).alias("score"), "prediction")


NAIVE_SQL = """WITH u AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
  (CAST(concat('0x', substr(md5(concat_ws(':', '3', CAST(vec_id AS VARCHAR))), 1, 13)) AS BIGINT) / 4503599627370496.0) < 0.3 AS is_valid FROM embeddings),
x AS (SELECT vec_id, label, is_valid, unnest(e) AS v, unnest(range(1, len(e) + 1)) AS j FROM u),
p AS (SELECT label, count(*) AS n FROM u WHERE NOT is_valid GROUP BY label),
m AS (SELECT label, j, avg(v) AS mu, var_pop(v) AS s2, sum(CAST(v > 0 AS DOUBLE)) AS ones FROM x WHERE NOT is_valid GROUP BY label, j),
eps AS (SELECT 1e-9 * max(s2) AS e FROM (SELECT j, var_pop(v) AS s2 FROM x WHERE NOT is_valid GROUP BY j)),
g AS (SELECT x.vec_id, x.label, m.label AS c, ln(p.n) + sum(-0.5 * ln(2 * pi() * (s2 + e)) - pow(v - mu, 2) / (2 * (s2 + e))) AS ll
      FROM x JOIN m USING (j) JOIN p ON p.label = m.label CROSS JOIN eps WHERE is_valid GROUP BY x.vec_id, x.label, m.label, p.n),
b AS (SELECT x.vec_id, x.label, m.label AS c, ln(p.n + 1) + sum(CASE WHEN v > 0 THEN ln((ones + 1) / (p.n + 2)) ELSE ln(1 - (ones + 1) / (p.n + 2)) END) AS ll
      FROM x JOIN m USING (j) JOIN p ON p.label = m.label WHERE is_valid GROUP BY x.vec_id, x.label, m.label, p.n)
SELECT vec_id, label, CAST(arg_max(c, ll) AS DOUBLE) AS prediction, 'gaussian' AS kind FROM g GROUP BY vec_id, label
UNION ALL SELECT vec_id, label, CAST(arg_max(c, ll) AS DOUBLE), 'bernoulli' FROM b GROUP BY vec_id, label"""


@plan("l10_naive_bayes", NAIVE_SQL)
def naive_bayes(spark, sf):
    df = labelled_vectors(spark, sf)
    bits = df.withColumn("features", array_to_vector(F.transform("embedding", lambda x: (x > 0).cast("double"))))
    g = _valid_scores(NaiveBayes(modelType="gaussian").fit(df.where("NOT is_valid")), df, "vec_id").withColumn("kind", F.lit("gaussian"))
    b = _valid_scores(NaiveBayes(modelType="bernoulli").fit(bits.where("NOT is_valid")), bits, "vec_id").withColumn("kind", F.lit("bernoulli"))
    return g.unionByName(b)


@plan("l11_knn_classifier", """
WITH n AS (SELECT a.vec_id AS query_id, b.label FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
  QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), b.vec_id) <= 5),
c AS (SELECT query_id, label, count(*) AS n FROM n GROUP BY ALL)
SELECT query_id, label AS prediction FROM c QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY n DESC, label) = 1""")
def knn_classifier(spark, sf):
    df = scan(spark, sf, "embeddings")
    return vote(nearest_neighbors(df, df, "vec_id", "embedding", 5, exclude_self=True), df, "vec_id", "label")


@plan("l12_shrunk_discriminant")
def discriminant(spark, sf):
    df = labelled_vectors(spark, sf)
    return Z.shrunk_discriminant(df.where("NOT is_valid"), "embedding", "label")(df.where("is_valid")).select("vec_id", "label", "prediction", "score")


@plan("l13_ridge_classifier")
def ridge_classifier(spark, sf):
    df = labelled_customers(spark, sf)
    _, predict = Z.ridge_classifier(df.where("fold <> 0"), "features", "label", 1.0)
    return predict(df.where("fold = 0")).select("c_custkey", "label", "score", "prediction")


@plan("l14_text_grid_search")
def text_grid(spark, sf):
    df = labelled_documents(spark, sf)
    svc = LinearSVC(maxIter=5)
    grid = ParamGridBuilder().addGrid(svc.regParam, [0.01, 0.1]).build()
    features = Z.text_features("text", english_stop_words(spark))
    return Z.feature_grid_search(features, svc, grid, df, ["doc_id"], "fold", 2, Z.f1_evaluator())


@plan("l15_model_comparison")
def comparison(spark, sf):
    models = {"logistic": LogisticRegression(maxIter=20), "tree": DecisionTreeClassifier(maxDepth=4, seed=1), "svm": LinearSVC(maxIter=10)}
    return Z.compare_models(models, labelled_customers(spark, sf), ["c_custkey"], "fold", 3)


@plan("l16_seasonal_baseline")
def seasonal_baseline(spark, sf):
    panel = materialize(full_panel(spark, sf), "panel")
    _, last = FC.K.day_bounds(panel, "day")
    return FC.seasonal_baseline(panel, KEYS, "v", last - dt.timedelta(364), last, 16)


@plan("l17_residual_target", f"""
WITH {PANEL_SQL} SELECT series, strftime(day, '%Y-%m-%d') AS day, round(v - avg(v) OVER (PARTITION BY series, isodow(day)), 4) + 0.0 AS residual FROM p WHERE v IS NOT NULL""")
def residual_target(spark, sf):
    panel = dense_panel(spark, sf).na.drop(subset=["v"])
    base = panel.groupBy("series", F.weekday("day").alias("wd")).agg(F.avg("v").alias("baseline"))
    baseline = panel.select("series", "day", F.weekday("day").alias("wd")).join(base, ["series", "wd"]).drop("wd")
    return FC.residuals(panel, baseline, KEYS, "v").select("series", day_text("day").alias("day"), rounded("residual").alias("residual"))


def hybrid_panel(spark, sf):
    panel = full_panel(spark, sf).join(promotions(spark, sf), ["series", "day"], "left").na.fill(0.0, ["promo"])
    return materialize(panel.select("series", "day", "v", "promo"), "panel")


def _future(panel, last, horizon):
    """Planned promotions for the horizon: those of the same days one year back."""
    return panel.where(F.col("day").between(F.lit(last - dt.timedelta(363)), F.lit(last - dt.timedelta(364 - horizon)))).select(
        "series", F.date_add("day", 364).alias("day"), "promo")


@plan("l18_hybrid_one_day")
def hybrid(spark, sf):
    panel = hybrid_panel(spark, sf)
    model = FC.HybridForecast(KEYS).fit(panel)
    ahead = _future(panel, model.last, 1).select("series", "day", F.lit(None).cast("double").alias("v"), "promo")
    return model.predict_day(panel.unionByName(ahead), model.last + dt.timedelta(1))


@plan("l19_recursive_horizon")
def recursive(spark, sf):
    panel = hybrid_panel(spark, sf)
    model = FC.HybridForecast(KEYS, trees=5).fit(panel)
    return FC.recursive_forecast(model, panel, _future(panel, model.last, 16), 16)


# --- the whole hybrid: 25 series keyed by priority and region ---------------------------

KEYS2 = ["series", "region"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

WHOLE_SQL = """o AS (SELECT o_orderpriority AS series, r_name AS region, CAST(o_orderdate AS DATE) AS day, o_totalprice AS p FROM orders
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
ob AS (SELECT series, region, day, sum(p) AS v, count(*) AS n FROM o GROUP BY ALL),
cal AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM ob),
fp AS (SELECT s.series, s.region, cal.day, coalesce(v, 0) AS v, coalesce(n, 0) AS n FROM (SELECT DISTINCT series, region FROM ob) s CROSS JOIN cal LEFT JOIN ob ON ob.series = s.series AND ob.region = s.region AND ob.day = cal.day),
e AS (SELECT max(day) AS last FROM fp)"""


def whole_panel(spark, sf):
    """Dense panel by priority and region: value, number of orders (the driver) and a promotion flag from the calendar."""
    from panelwright.operators.panel import daily_panel, dense_daily
    rows = scan(spark, sf, "orders").join(scan(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(
        scan(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(scan(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    daily = daily_panel(rows, {"series": F.col("o_orderpriority"), "region": F.col("r_name")}, F.col("o_orderdate"), {"v": F.sum("o_totalprice"), "n": F.count(F.lit(1)).cast("double")})
    dense = dense_daily(daily, KEYS2, shared_calendar=True).na.fill(0.0, ["v", "n"])
    return materialize(dense.withColumn("promo", (F.dayofmonth("day") <= 3).cast("double")), "whole-panel")


def whole_model(spark, sf, panel, trees=5):
    first, last = FC.K.day_bounds(panel, "day")
    days = FC.calendar_days(panel, first, last + dt.timedelta(16))
    weekly = FC.P.weekly_driver_features(driver(spark, sf), "price", days, returns=False)
    national = ((F.month("day") == 7) & (F.dayofmonth("day") == 4)) | ((F.month("day") == 12) & (F.dayofmonth("day") == 25))
    day_table = materialize(days.withColumn("national", national.cast("double")).join(weekly, "day", "left").na.fill(0.0), "day-table")
    places = days.where((F.month("day") == 5) & (F.dayofmonth("day") == 1)).select("day", F.explode(F.array(F.lit("EUROPE"), F.lit("ASIA"))).alias("region"), F.lit(1.0).alias("local_holiday"))
    meta = panel.select(*KEYS2).distinct().withColumns({"region_name": F.col("region"), "urgent": F.col("series").rlike("^[12]").cast("double")})
    return FC.WholeForecast(KEYS2, trees=trees, depth=3, driver="n", day_table=day_table, metadata=meta, domains={"region_name": REGIONS}, place_events=places, place="region")


@plan("l18_whole_feature_day", f"""
WITH {WHOLE_SQL}, l AS (SELECT fp.*, date_diff('day', day, last) + 1 AS k FROM fp, e WHERE day > last - 9)
SELECT series, region, strftime(last + 1, '%Y-%m-%d') AS day, {", ".join(f"round(max(v) FILTER (WHERE k = {k}), 2) + 0.0 AS y_lag_{k}, round(max(ln(1 + n)) FILTER (WHERE k = {k}), 6) + 0.0 AS driver_lag_{k}" for k in (1, 2, 9))},
  CAST((month(last + 1) = 7 AND day(last + 1) = 4) OR (month(last + 1) = 12 AND day(last + 1) = 25) AS DOUBLE) AS "national",
  CAST(day(last + 1) <= 3 AS DOUBLE) AS onp_expo_0_2, CAST(isodow(last + 1) - 1 AS DOUBLE) AS weekday, CAST(month(last + 1) AS DOUBLE) AS month,
  CAST(month(last + 1) = 5 AND day(last + 1) = 1 AND region IN ('EUROPE', 'ASIA') AS DOUBLE) AS local_holiday, CAST(series[1] IN ('1', '2') AS DOUBLE) AS urgent,
  CAST(region = 'ASIA' AS DOUBLE) AS "region_name_ASIA", CAST(region = 'EUROPE' AS DOUBLE) AS "region_name_EUROPE"
FROM l, e GROUP BY series, region, last""")
def whole_features(spark, sf):
    panel = whole_panel(spark, sf)
    model = whole_model(spark, sf, panel)
    model.first, last = FC.K.day_bounds(panel, "day")
    ahead = panel.where(F.col("day") == F.lit(last)).select(*KEYS2, F.lit(last + dt.timedelta(1)).alias("day"), F.lit(None).cast("double").alias("v"), F.lit(None).cast("double").alias("n"),
                                                            (F.dayofmonth(F.lit(last + dt.timedelta(1))) <= 3).cast("double").alias("promo"))
    both, at = panel.unionByName(ahead), F.col("day") == F.lit(last + dt.timedelta(1))
    base = model.baseline_rows(both).where(at).select(*KEYS2, "national", *[f"driver_lag_{k}" for k in (1, 2, 9)])
    rows = model._features(both).where(at).join(base, KEYS2)
    return rows.select(*KEYS2, day_text("day").alias("day"), *[x for k in (1, 2, 9) for x in (rounded(f"y_lag_{k}", 2).alias(f"y_lag_{k}"), rounded(f"driver_lag_{k}", 6).alias(f"driver_lag_{k}"))],
                       "national", "onp_expo_0_2", "weekday", "month", "local_holiday", "urgent", "region_name_ASIA", "region_name_EUROPE")


@plan("l19_two_day_recursion", f"""
WITH {WHOLE_SQL}, x AS (SELECT series, region, day, v, lag(v) OVER (PARTITION BY series, region ORDER BY day) AS l FROM fp),
f AS (SELECT series, region, covar_pop(v, l) * count(*) / nullif(var_pop(l) * count(*) + 10 * var_pop(l), 0) AS b, avg(v) AS my, avg(l) AS mx FROM x WHERE l IS NOT NULL GROUP BY ALL),
d1 AS (SELECT f.*, last, greatest(my + coalesce(b, 0) * (v - mx), 0) AS p1 FROM f JOIN fp USING (series, region), e WHERE day = last)
SELECT series, region, strftime(last + 1, '%Y-%m-%d') AS day, round(p1, 2) + 0.0 AS forecast FROM d1
UNION ALL SELECT series, region, strftime(last + 2, '%Y-%m-%d'), round(greatest(my + coalesce(b, 0) * (p1 - mx), 0), 2) + 0.0 FROM d1""")
def two_days(spark, sf):
    panel = whole_panel(spark, sf)
    model = FC.WholeForecast(KEYS2, lags=1, trees=0, calendar=False).fit(panel)
    ahead = panel.select(*KEYS2).distinct().withColumn("day", F.explode(F.sequence(F.lit(model.last + dt.timedelta(1)), F.lit(model.last + dt.timedelta(2))))).withColumn("promo", F.lit(0.0))
    out = FC.recursive_forecast(model, panel, ahead, 2)
    return out.select(*KEYS2, day_text("day").alias("day"), rounded("forecast", 2).alias("forecast"))


@plan("l19_whole_horizon")
def whole_horizon(spark, sf):
    panel = whole_panel(spark, sf)
    model = whole_model(spark, sf, panel).fit(panel)
    orders = FC.driver_forecast(panel, KEYS2, "n", 16)
    ahead = orders.withColumn("promo", (F.dayofmonth("day") <= 3).cast("double"))
    return FC.recursive_forecast(model, panel, ahead, 16)


def _two_scores(spark, sf):
    df = labelled_customers(spark, sf)

    def oof(estimator, name):
        return Z.out_of_fold(df, "fold", 3, estimator.fit, lambda s: s.select("c_custkey", positive_probability().alias(name)))

    scores = oof(LogisticRegression(maxIter=20), "s_logistic").join(oof(DecisionTreeClassifier(maxDepth=4, seed=1), "s_tree"), "c_custkey")
    return materialize(df.select("c_custkey", "label", "fold").join(scores, "c_custkey"), "scores")


@plan("k7_out_of_fold_scores")
def out_of_fold(spark, sf):
    return _two_scores(spark, sf)


def _bag_sql(b):
    from panelwright.plans.splits import POISSON_ONE, uniform_sql
    u = uniform_sql("CAST(p_partkey AS VARCHAR)", f"0.{b}")
    return " + ".join(f"CAST({u} >= {p!r} AS INTEGER)" for p in POISSON_ONE)


@plan("k6_bagged_scores", f"""
WITH p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS x, p_retailprice / 10 + p_size * 2 AS y, {", ".join(f"{_bag_sql(b)} AS w{b}" for b in range(3))} FROM part),
""" + ",\n".join(f"""s{b} AS (SELECT (sum(w{b} * x * y) / sum(w{b}) - sum(w{b} * x) / sum(w{b}) * sum(w{b} * y) / sum(w{b})) / (sum(w{b} * x * x) / sum(w{b}) - pow(sum(w{b} * x) / sum(w{b}), 2)) AS a{b},
  sum(w{b} * x) / sum(w{b}) AS mx{b}, sum(w{b} * y) / sum(w{b}) AS my{b} FROM p)""" for b in range(3)) + """
SELECT p_partkey, round((my0 + a0 * (x - mx0) + my1 + a1 * (x - mx1) + my2 + a2 * (x - mx2)) / 3, 4) + 0.0 AS score FROM p, s0, s1, s2""")
def bagged(spark, sf):
    df = assemble(priced_parts(spark, sf).drop("features"), ["p_size"])
    out = Z.bagged_scores(LinearRegression(solver="normal"), df, df, ["p_partkey"], 3, lambda s: F.col("prediction"))
    return out.select("p_partkey", rounded("score").alias("score"))


@plan("k7_out_of_fold_linear", """
WITH p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS x, p_retailprice / 10 + p_size * 2 AS y,
  CAST(concat('0x', substr(md5(concat_ws(':', '5', CAST(p_partkey AS VARCHAR))), 1, 8)) AS BIGINT) % 3 AS fold FROM part),
s AS (SELECT k, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM p, (SELECT unnest([0, 1, 2]) AS k) g WHERE fold <> k GROUP BY k)
SELECT p_partkey, CAST(fold AS INTEGER) AS fold, round(b + a * x, 4) + 0.0 AS prediction FROM p JOIN s ON s.k = p.fold""")
def out_of_fold_linear(spark, sf):
    df = assemble(priced_parts(spark, sf).drop("features"), ["p_size"])
    out = Z.out_of_fold(df, "fold", 3, LinearRegression(solver="normal").fit, lambda s: s.select("p_partkey", "fold", "prediction"))
    return out.select("p_partkey", "fold", rounded("prediction").alias("prediction"))


@plan("l2_penalty_search_one_regressor", f"""
WITH {FULL_SQL}, c AS (SELECT max(day) - 180 AS cut FROM fp), tr AS (SELECT series, regr_slope(v, t) AS b, avg(v) AS m, avg(t) AS mt, count(*) AS n FROM fp, c WHERE day <= cut GROUP BY series),
p AS (SELECT alpha, v, m + b * n / (n + alpha) * (t - mt) AS p FROM fp JOIN tr USING (series) CROSS JOIN (SELECT unnest([0.0, 10.0, 1000.0, 100000.0]) AS alpha) g, c WHERE day > cut)
SELECT CAST(alpha AS DOUBLE) AS alpha, round(sqrt(avg(pow(ln(1 + greatest(p, 0)) - ln(1 + greatest(v, 0)), 2))), 6) + 0.0 AS rmsle, round(sqrt(avg(pow(p - v, 2))), 2) + 0.0 AS rmse FROM p GROUP BY alpha""")
def penalty_search_one(spark, sf):
    panel = materialize(full_panel(spark, sf), "panel")
    design, _, last = design_for(panel)
    design, cut = design.select("day", "trend"), F.lit(last - dt.timedelta(180))
    model = ManyTargetRidge(KEYS, "v", ["trend"]).fit(panel.where(F.col("day") <= cut), design.where(F.col("day") <= cut))
    out = model.search(panel.where(F.col("day") > cut), design.where(F.col("day") > cut), [0.0, 10.0, 1000.0, 100000.0])
    return out.select("alpha", rounded("rmsle", 6).alias("rmsle"), rounded("rmse", 2).alias("rmse"))


@plan("l21_stacking")
def stacking(spark, sf):
    scores = assemble(_two_scores(spark, sf), ["s_logistic", "s_tree"])
    meta = LogisticRegression(maxIter=30)
    grid = ParamGridBuilder().addGrid(meta.regParam, [0.001, 0.01, 0.1]).build()
    best = Z.grid_search(meta, grid, scores, "fold", Z.area_evaluator(), 3)
    return best.transform(scores).select("c_custkey", "label", positive_probability().alias("score"), "prediction")


def length_logits(inputs):
    """Reference scorer: the longer side wins, a tie is likely when lengths are close."""
    def load():
        def predict(pdf: pd.DataFrame) -> np.ndarray:
            gap = (pdf[inputs[0]].str.len() - pdf[inputs[1]].str.len()).to_numpy() / 100.0
            return np.stack([gap, -gap, 1 - np.abs(gap)], axis=1)
        return predict
    return load


LOGITS_SQL = f"""lg AS (SELECT conv_id, turn, (length(premise) - length(hypothesis)) / 100.0 AS a, -(length(premise) - length(hypothesis)) / 100.0 AS b,
  1 - abs(length(premise) - length(hypothesis)) / 100.0 AS c FROM {PAIRS_SQL}), e AS (SELECT *, greatest(a, b, c) AS m FROM lg),
pr AS (SELECT conv_id, turn, exp(a - m) / (exp(a - m) + exp(b - m) + exp(c - m)) AS p1, exp(b - m) / (exp(a - m) + exp(b - m) + exp(c - m)) AS p2,
  exp(c - m) / (exp(a - m) + exp(b - m) + exp(c - m)) AS p3 FROM e)"""


@plan("l24_batch_scoring", f"""WITH {LOGITS_SQL} SELECT conv_id, turn, round(p1, 6) + 0.0 AS p_first, round(p2, 6) + 0.0 AS p_second, round(p3, 6) + 0.0 AS p_tie,
  CAST(CASE WHEN p1 >= p2 AND p1 >= p3 THEN 0 WHEN p2 >= p3 THEN 1 ELSE 2 END AS INTEGER) AS prediction FROM pr""")
def batch_scoring(spark, sf):
    inputs = ["premise", "hypothesis"]
    out = SC.score_batches(conversation_pairs(spark, sf), ["conv_id", "turn"], inputs, length_logits(inputs), 3)
    return out.select("conv_id", "turn", *[rounded(F.get("probability", F.lit(i)), 6).alias(n) for i, n in enumerate(("p_first", "p_second", "p_tie"))], "prediction")


@plan("l25_symmetric_scoring", f"""WITH {LOGITS_SQL} SELECT conv_id, turn, round(p1, 6) + 0.0 AS p_first, round(p2, 6) + 0.0 AS p_second, round(p3, 6) + 0.0 AS p_tie FROM pr""")
def symmetric(spark, sf):
    def scorer(df, a, b):
        gap = (F.char_length(a) - F.char_length(b)) / 100.0
        p = SC.softmax([gap, -gap, 1 - F.abs(gap)])
        return df.select("conv_id", "turn", p[0].alias("p_first"), p[1].alias("p_second"), p[2].alias("p_tie"))

    out = SC.symmetric_scores(conversation_pairs(spark, sf), ["conv_id", "turn"], "premise", "hypothesis", scorer)
    return out.select("conv_id", "turn", *[rounded(c, 6).alias(c) for c in ("p_first", "p_second", "p_tie")])


@plan("l26_feature_importance")
def feature_importance(spark, sf):
    df = priced_parts(spark, sf)
    return Z.importances(GBTRegressor(maxIter=5, maxDepth=4, seed=1).fit(df), PART_FEATURES, df)


@plan("l27_sampled_attribution")
def attribution(spark, sf):
    df = priced_parts(spark, sf).drop("features")
    trees = [(DecisionTreeRegressor(maxDepth=5, seed=1), 1.0), (LinearRegression(), 2.0)]
    data = assemble(df, PART_FEATURES)
    parts = [(Z.shapley_values(e.fit(data), df, ["p_partkey"], PART_FEATURES, background=50, permutations=2), w) for e, w in trees]
    return Z.mean_attribution(parts)


@plan("l28_feature_drop_curve")
def drop_curve(spark, sf):
    df = priced_parts(spark, sf)
    weakest = [r["feature"] for r in Z.importances(DecisionTreeRegressor(maxDepth=5, seed=1).fit(df), PART_FEATURES, df).orderBy(F.col("rank").desc()).collect()]
    return Z.feature_drop_curve(df.drop("features"), PART_FEATURES, weakest, DecisionTreeRegressor(maxDepth=5, seed=1), Z.regression_rmse(), "fold", 3, [0, 1, 2])


# --- user surface ------------------------------------------------------------------------

@plan("p1_custom_transformer", """
SELECT p_partkey, round(CASE WHEN p_retailprice > 0 THEN p_size / p_retailprice ELSE 0 END, 8) + 0.0 AS ratio FROM part""")
def custom_transformer(spark, sf):
    from pyspark.ml import Pipeline
    df = scan(spark, sf, "part")
    out = Pipeline(stages=[U.RatioFeature("p_size", "p_retailprice", "ratio")]).fit(df).transform(df)
    return out.select("p_partkey", rounded("ratio", 8).alias("ratio"))


@plan("p2_model_adapter", """
WITH t AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM customer)
SELECT c_custkey, round(1 / (1 + exp(-(c_acctbal - m) / s)), 6) + 0.0 AS probability, CAST(c_acctbal >= m AS INTEGER) AS prediction FROM customer, t""")
def model_adapter(spark, sf):
    df = scan(spark, sf, "customer", ["c_custkey", "c_acctbal"])

    def fit_state(train):
        return train.agg(F.avg("c_acctbal").alias("m"), F.stddev_pop("c_acctbal").alias("s")).first().asDict()

    def predict(batch, state):
        return 1 / (1 + np.exp(-(batch["c_acctbal"] - state["m"]) / state["s"]))

    out = SC.ModelAdapter(["c_acctbal"], fit_state, predict).fit(df).transform(df)
    return out.select("c_custkey", rounded("probability", 6).alias("probability"), "prediction")


@plan("p3_user_aggregate", """
SELECT o_orderpriority, round(max(o_totalprice) - min(o_totalprice), 2) + 0.0 AS price_range FROM orders GROUP BY ALL""")
def user_aggregate(spark, sf):
    out = U.user_aggregate(
        scan(spark, sf, "orders"), ["o_orderpriority"], "o_totalprice",
        partial=lambda v: [float(v.min()), float(v.max())], merge=lambda a, b: [min(a[0], b[0]), max(a[1], b[1])],
        finish=lambda s: s[1] - s[0], out="price_range")
    return out.withColumn("price_range", rounded("price_range", 2))


@plan("p4_row_function", "SELECT c_custkey, CAST(len(string_split(c_name, '#')) AS INTEGER) AS n_parts, upper(c_mktsegment) || '-' || c_nationkey AS code FROM customer")
def row_function(spark, sf):
    native = F.size(F.split("c_name", "#")).alias("n_parts")
    opaque = U.row_function(lambda b: b["c_mktsegment"].str.upper() + "-" + b["c_nationkey"].astype(str), ["c_mktsegment", "c_nationkey"], "string")
    return scan(spark, sf, "customer").select("c_custkey", native, opaque.alias("code"))


@plan("p5_per_series_function", f"""
WITH {PANEL_SQL} SELECT series, strftime(day, '%Y-%m-%d') AS day, CAST(sum(coalesce(n, 0)) OVER (PARTITION BY series ORDER BY day) AS BIGINT) AS running FROM p""")
def per_series(spark, sf):
    def running(pdf):
        return pd.DataFrame({"series": pdf["series"], "day": pdf["day"], "running": pdf["n"].fillna(0).cumsum().astype("int64")})

    out = U.per_series(dense_panel(spark, sf).select("series", "day", "n"), KEYS, running, "series string, day date, running long")
    return out.withColumn("day", day_text("day"))
