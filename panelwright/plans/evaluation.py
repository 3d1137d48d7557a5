"""Metric, association, drift and score-combination plans."""

from statistics import NormalDist

from pyspark.sql import functions as F

from panelwright.functions.expr import TRANSFORMS
from panelwright.operators import drift as D, metrics as M
from panelwright.operators.profile import column_range
from panelwright.operators.reshape import spearman_matrix
from panelwright.operators.series import guarded_corr
from panelwright.plans.registry import plan, rounded
from panelwright.plans.reshape import spearman_sql
from panelwright.sources.tables import scan

# A score with ties on the line items: label = returned, score from price and quantity.
SCORED_SQL = """(SELECT l_orderkey, CAST(l_returnflag = 'R' AS INTEGER) AS y, round(l_extendedprice / 110000 * 0.7 + l_discount * 3, 2) AS s,
  round(l_quantity / 50, 2) AS s2 FROM lineitem)"""


def scored(spark, sf):
    return scan(spark, sf, "lineitem").select(
        "l_orderkey", (F.col("l_returnflag") == "R").cast("int").alias("y"),
        F.round(F.col("l_extendedprice") / 110000 * 0.7 + F.col("l_discount") * 3, 2).alias("s"), F.round(F.col("l_quantity") / 50, 2).alias("s2"))


PREDICTED_SQL = """(SELECT doc_id, lang, quality AS y, CAST(n_chars > 700 AS INTEGER) AS p, CAST(n_chars % 3 > 0 AS INTEGER) AS p2
  FROM labels JOIN documents USING (doc_id))"""


def predicted(spark, sf):
    return scan(spark, sf, "labels").join(scan(spark, sf, "documents"), "doc_id").select(
        "doc_id", "lang", F.col("quality").alias("y"), (F.col("n_chars") > 700).cast("int").alias("p"), (F.col("n_chars") % 3 > 0).cast("int").alias("p2"))


@plan("n1_accuracy_by_group", f"SELECT lang, round(avg(CAST(y = p AS INTEGER)), 6) + 0.0 AS accuracy, count(*) AS n FROM {PREDICTED_SQL} GROUP BY lang")
def accuracy(spark, sf):
    return M.accuracy(predicted(spark, sf), "y", "p", ["lang"]).withColumn("accuracy", rounded("accuracy", 6))


@plan("n1_macro_accuracy", f"SELECT round(avg(a), 6) + 0.0 AS macro_accuracy, count(*) AS n_groups FROM (SELECT avg(CAST(y = p AS INTEGER)) AS a FROM {PREDICTED_SQL} GROUP BY lang)")
def macro_accuracy(spark, sf):
    return M.macro_accuracy(predicted(spark, sf), "y", "p", "lang").withColumn("macro_accuracy", rounded("macro_accuracy", 6))


@plan("n2_confusion", f"SELECT y AS label, p AS prediction, count(*) AS n FROM {PREDICTED_SQL} GROUP BY ALL")
def confusion(spark, sf):
    return M.confusion(predicted(spark, sf), "y", "p")


@plan("n2_class_report", f"""
WITH c AS (SELECT k AS cls, count(*) FILTER (WHERE y = k) AS support, count(*) FILTER (WHERE p = k) AS predicted, count(*) FILTER (WHERE y = k AND p = k) AS hit
  FROM {PREDICTED_SQL}, (SELECT unnest([0, 1]) AS k) g GROUP BY k)
SELECT cls, support, round(hit / predicted, 6) + 0.0 AS precision, round(hit / support, 6) + 0.0 AS recall, round(2 * hit / (support + predicted), 6) + 0.0 AS f1 FROM c""")
def class_report(spark, sf):
    return M.class_report(predicted(spark, sf), "y", "p").select("cls", "support", *[rounded(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@plan("n3_log_loss", f"SELECT round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) + 0.0 AS log_loss FROM (SELECT y, least(greatest(s, 1e-15), 1 - 1e-15) AS p FROM {SCORED_SQL})")
def log_loss(spark, sf):
    return scored(spark, sf).agg(rounded(M.log_loss(F.col("y"), F.col("s")), 6).alias("log_loss"))


@plan("n4_roc_auc", f"""
WITH g AS (SELECT s, sum(y) AS p, sum(1 - y) AS n FROM {SCORED_SQL} GROUP BY s), c AS (SELECT p, n, sum(n) OVER (ORDER BY s) - n AS below FROM g)
SELECT round(CAST(sum(p * (below + n / 2)) AS DOUBLE) / (CAST(sum(p) AS DOUBLE) * CAST(sum(n) AS DOUBLE)), 8) + 0.0 AS auc FROM c""")
def roc_auc(spark, sf):
    return M.roc_auc(scored(spark, sf), "y", "s").select(rounded("auc", 8).alias("auc"))


@plan("n5_average_precision", f"""
WITH g AS (SELECT s, sum(y) AS p, count(*) AS n FROM {SCORED_SQL} GROUP BY s), c AS (SELECT p, sum(p) OVER (ORDER BY s DESC) AS tp, sum(n) OVER (ORDER BY s DESC) AS called FROM g)
SELECT round(sum(p * tp / called) / sum(p), 8) + 0.0 AS average_precision FROM c""")
def average_precision(spark, sf):
    return M.average_precision(scored(spark, sf), "y", "s").select(rounded("average_precision", 8).alias("average_precision"))


@plan("n6_regression_errors", "SELECT round(avg(pow(l_extendedprice - l_quantity * 1800, 2)), 2) + 0.0 AS mse, round(sqrt(avg(pow(l_extendedprice - l_quantity * 1800, 2))), 4) + 0.0 AS rmse FROM lineitem")
def regression_errors(spark, sf):
    y, p = F.col("l_extendedprice"), F.col("l_quantity") * 1800
    return scan(spark, sf, "lineitem").agg(rounded(M.mse(y, p), 2).alias("mse"), rounded(M.rmse(y, p)).alias("rmse"))


@plan("n7_rmsle", "SELECT round(sqrt(avg(pow(ln(1 + greatest(l_extendedprice, 0)) - ln(1 + greatest(l_quantity * 1800 - 3000, 0)), 2))), 6) + 0.0 AS rmsle FROM lineitem")
def rmsle(spark, sf):
    return scan(spark, sf, "lineitem").agg(rounded(M.rmsle(F.col("l_extendedprice"), F.col("l_quantity") * 1800 - 3000), 6).alias("rmsle"))


@plan("n8_chi_square", """
WITH c AS (SELECT l_returnflag, l_linestatus, count(*) AS o FROM lineitem GROUP BY ALL),
e AS (SELECT o, CAST(sum(o) OVER (PARTITION BY l_returnflag) AS DOUBLE) * CAST(sum(o) OVER (PARTITION BY l_linestatus) AS DOUBLE) / CAST(sum(o) OVER () AS DOUBLE) AS x FROM c)
SELECT round(sum(pow(o - x, 2) / x), 6) + 0.0 AS chi2, CAST(2 AS BIGINT) AS dof, CAST(sum(o) AS BIGINT) AS n, round(exp(-sum(pow(o - x, 2) / x) / 2), 8) + 0.0 AS p_value FROM e""")
def chi_square(spark, sf):
    return M.chi_square(scan(spark, sf, "lineitem"), "l_returnflag", "l_linestatus").select(
        rounded("chi2", 6).alias("chi2"), "dof", "n", rounded("p_value", 8).alias("p_value"))


@plan("n8_chi_square_yates", """
WITH c AS (SELECT l_linestatus AS a, l_quantity > 25 AS b, count(*) AS o FROM lineitem GROUP BY ALL),
e AS (SELECT o, CAST(sum(o) OVER (PARTITION BY a) AS DOUBLE) * CAST(sum(o) OVER (PARTITION BY b) AS DOUBLE) / CAST(sum(o) OVER () AS DOUBLE) AS x FROM c)
SELECT round(sum(pow(abs(o - x) - least(0.5, abs(o - x)), 2) / x), 6) + 0.0 AS chi2, CAST(1 AS BIGINT) AS dof, CAST(sum(o) AS BIGINT) AS n FROM e""")
def chi_square_yates(spark, sf):
    df = scan(spark, sf, "lineitem").withColumn("many", F.col("l_quantity") > 25)
    return M.chi_square(df, "l_linestatus", "many").select(rounded("chi2", 6).alias("chi2"), "dof", "n")


@plan("n9_point_biserial", f"SELECT round(covar_pop(s2, y) / nullif(stddev_pop(s2) * stddev_pop(y), 0), 8) + 0.0 AS r FROM {SCORED_SQL}")
def point_biserial(spark, sf):
    return scored(spark, sf).agg(rounded(guarded_corr(F.col("s2"), F.col("y")), 8).alias("r"))


@plan("n10_mcnemar", f"""
WITH c AS (SELECT count(*) FILTER (WHERE p = y AND p2 <> y) AS b, count(*) FILTER (WHERE p <> y AND p2 = y) AS c FROM {PREDICTED_SQL})
SELECT b AS only_first, c AS only_second, round(pow(greatest(abs(b - c) - 1, 0), 2) / (b + c), 6) + 0.0 AS statistic FROM c""")
def mcnemar(spark, sf):
    return M.mcnemar(predicted(spark, sf), "y", "p", "p2").select("only_first", "only_second", rounded("statistic", 6).alias("statistic"))


@plan("n11_spearman_matrix", spearman_sql(["p_size", "p_retailprice", "p_partkey"], "part") + " SELECT a, b, round(rho, 6) + 0.0 AS rho FROM m")
def spearman(spark, sf):
    m = spearman_matrix(scan(spark, sf, "part"), ["p_size", "p_retailprice", "p_partkey"], ["p_partkey"])
    return m.select("a", "b", rounded("rho", 6).alias("rho"))


def _jb_sql(name, x):
    return f"""SELECT '{name}' AS transform, count(*) AS n, avg(pow(x - m, 3)) / pow(avg(pow(x - m, 2)), 1.5) AS s, avg(pow(x - m, 4)) / pow(avg(pow(x - m, 2)), 2) - 3 AS k
      FROM (SELECT {x} AS x, avg({x}) OVER () AS m FROM part)"""


@plan("n12_normality", f"""
WITH j AS ({_jb_sql('raw', 'p_retailprice')} UNION ALL {_jb_sql('log1p', 'ln(1 + p_retailprice)')} UNION ALL {_jb_sql('sqrt', 'sqrt(p_retailprice)')})
SELECT transform, n, round(s, 6) + 0.0 AS skewness, round(k, 6) + 0.0 AS kurtosis, round(n / 6.0 * (s * s + k * k / 4), 4) + 0.0 AS statistic,
  round(exp(-n / 12.0 * (s * s + k * k / 4)), 8) + 0.0 AS p_value FROM j""")
def normality(spark, sf):
    x = F.col("p_retailprice")
    out = M.jarque_bera(scan(spark, sf, "part"), {n: TRANSFORMS[n](x) for n in ("raw", "log1p", "sqrt")})
    return out.select("transform", "n", rounded("skewness", 6).alias("skewness"), rounded("kurtosis", 6).alias("kurtosis"),
                      rounded("statistic").alias("statistic"), rounded("p_value", 8).alias("p_value"))


@plan("n12_quantile_quantile", """
SELECT CAST(p / 20.0 AS DOUBLE) AS probability, round(list_extract(q, p), 4) + 0.0 AS sample,
  round(m + s * list_extract([""" + ", ".join(repr(NormalDist().inv_cdf(i / 20)) for i in range(1, 20)) + """], p), 4) + 0.0 AS "normal" FROM (SELECT unnest(range(1, 20)) AS p) g,
  (SELECT quantile_cont(o_totalprice, [""" + ", ".join(str(i / 20) for i in range(1, 20)) + """]) AS q, avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s FROM orders)""")
def qq(spark, sf):
    out = M.quantile_quantile(scan(spark, sf, "orders"), "o_totalprice")
    return out.select(F.col("probability"), rounded("sample").alias("sample"), rounded("normal").alias("normal"))


def half_months(spark, sf):
    events = scan(spark, sf, "events")
    early = F.dayofmonth("ts") <= 15
    return events.where(early), events.where(~early)


@plan("n13_categorical_drift", """
WITH c AS (SELECT event_type, dayofmonth(ts) <= 15 AS early, count(*) AS n FROM events GROUP BY ALL),
s AS (SELECT event_type, early, n / CAST(sum(n) OVER (PARTITION BY early) AS DOUBLE) AS share FROM c)
SELECT round(max(abs(b - a)), 8) + 0.0 AS l_infinity, count(*) AS n_levels FROM (SELECT event_type, coalesce(max(share) FILTER (WHERE early), 0) AS a,
  coalesce(max(share) FILTER (WHERE NOT early), 0) AS b FROM s GROUP BY event_type)""")
def categorical_drift(spark, sf):
    base, current = half_months(spark, sf)
    return D.categorical_drift(base, current, "event_type").withColumn("l_infinity", rounded("l_infinity", 8))


@plan("n14_numeric_drift", """
WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events WHERE dayofmonth(ts) <= 15),
b AS (SELECT dayofmonth(ts) <= 15 AS early, CAST(least(greatest(floor((value - lo) / ((hi - lo) / 20)), 0), 19) AS INTEGER) AS bin, count(*) AS n FROM events, r GROUP BY ALL),
s AS (SELECT bin, early, n / CAST(sum(n) OVER (PARTITION BY early) AS DOUBLE) AS share FROM b),
w AS (SELECT bin, coalesce(max(share) FILTER (WHERE early), 0) AS p, coalesce(max(share) FILTER (WHERE NOT early), 0) AS q FROM s GROUP BY bin)
SELECT round(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2, 8) + 0.0 AS js_divergence, count(*) AS n_bins FROM w""")
def numeric_drift(spark, sf):
    base, current = half_months(spark, sf)
    low, high = column_range(base, "value")
    return D.numeric_drift(base, current, "value", low, high).withColumn("js_divergence", rounded("js_divergence", 8))


@plan("l20_blend_search", f"""
SELECT CAST(w / 10.0 AS DOUBLE) AS w1, round(avg(CAST((s * (w / 10.0) + s2 * (1 - w / 10.0) >= 0.5 - 1e-9) = (y = 1) AS INTEGER)), 6) + 0.0 AS accuracy
FROM {SCORED_SQL}, (SELECT unnest(range(0, 11)) AS w) g GROUP BY w""")
def blend_search(spark, sf):
    grid = [(i / 10, 1 - i / 10) for i in range(11)]
    out = M.blend_search(scored(spark, sf), "y", ["s", "s2"], grid, threshold=0.5 - 1e-9)
    return out.select(F.get("weights", F.lit(0)).alias("w1"), rounded("accuracy", 6).alias("accuracy"))


@plan("l22_threshold_sweep", f"""
SELECT round(0.05 + 0.9 * i / 180.0, 6) AS threshold, round(avg(CAST((s >= 0.05 + 0.9 * i / 180.0 + 1e-9) = (y = 1) AS INTEGER)), 6) + 0.0 AS accuracy, count(*) AS n
FROM {SCORED_SQL}, (SELECT unnest(range(0, 181)) AS i) g GROUP BY i""")
def sweep(spark, sf):
    # the scores are shifted off the cut-offs, where engines could round differently
    df = scored(spark, sf).withColumn("s", F.col("s") - 1e-9)
    out = M.threshold_sweep(df, "y", "s")
    return out.select(F.round("threshold", 6).alias("threshold"), rounded("accuracy", 6).alias("accuracy"), "n")


@plan("l23_generalisation_gap", f"""
WITH a AS (SELECT CASE WHEN doc_id % 5 = 0 THEN 'valid' WHEN doc_id % 5 = 1 THEN 'slice' ELSE 'train' END AS part, avg(CAST(y = p AS INTEGER)) AS a, count(*) AS n FROM {PREDICTED_SQL} GROUP BY ALL)
SELECT part, round(a, 6) + 0.0 AS accuracy, n, round(abs(a - (SELECT a FROM a WHERE part = 'train')), 6) + 0.0 AS gap, abs(a - (SELECT a FROM a WHERE part = 'train')) > 0.01 AS flagged FROM a""")
def gap(spark, sf):
    m = F.col("doc_id") % 5
    df = predicted(spark, sf).withColumn("part", F.when(m == 0, "valid").when(m == 1, "slice").otherwise("train"))
    out = M.generalisation_gap(df, "y", "p", "part", "train")
    return out.select("part", rounded("accuracy", 6).alias("accuracy"), "n", rounded("gap", 6).alias("gap"), "flagged")
