"""Window plans over rows, groups and the order panel."""

from pyspark.sql import functions as F

from panelwright.operators import panel as P
from panelwright.operators.reshape import keep_one
from panelwright.operators.scale import average_ranks, exact_quantiles, join_lookup, with_group_stats
from panelwright.operators.series import guarded_corr
from panelwright.plans.expressions import GAPPY, gappy_customers
from panelwright.plans.panels import KEYS, PANEL_SQL, PROMO_SQL, dense_panel, promotions
from panelwright.plans.registry import day_text, plan, rounded
from panelwright.sources.tables import scan


def iso_day():
    return day_text("day").alias("day")


DAY_SQL = "strftime(day, '%Y-%m-%d') AS day"


@plan("flagship_panel_features", f"""
WITH {PANEL_SQL},
o AS (SELECT *, max(CAST(v IS NOT NULL AS INTEGER)) OVER (PARTITION BY series ORDER BY day) = 1
  AND max(CAST(v IS NOT NULL AS INTEGER)) OVER (PARTITION BY series ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) = 1 AS opn,
  quantile_cont(v, 0.5) OVER (PARTITION BY series, isodow(day)) AS md, quantile_cont(v, 0.5) OVER (PARTITION BY series) AS ms FROM p),
f AS (SELECT series, day, coalesce(v, CASE WHEN opn THEN coalesce(md, ms) ELSE 0.0 END) AS v FROM o)
SELECT series, {DAY_SQL}, round(v, 4) + 0.0 AS v,
  {", ".join(f"round(lag(v, {k}) OVER w, 4) + 0.0 AS y_lag_{k}" for k in range(1, 8))}
FROM f WINDOW w AS (PARTITION BY series ORDER BY day)""")
def flagship(spark, sf):
    filled = P.fill_gaps(dense_panel(spark, sf), KEYS, "v")
    lagged = filled.withColumns(P.lag_block("v", 7, KEYS))
    return lagged.select("series", iso_day(), rounded("v").alias("v"),
                         *[rounded(f"y_lag_{k}").alias(f"y_lag_{k}") for k in range(1, 8)])


@plan("f1_group_size", """
SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey) AS group_size FROM lineitem""")
def group_size(spark, sf):
    li = scan(spark, sf, "lineitem", ["l_orderkey", "l_linenumber"])
    return with_group_stats(li, ["l_orderkey"], {"group_size": F.count(F.lit(1))})


@plan("f2_group_median_fill", f"""
SELECT c_custkey, round(coalesce(acctbal, quantile_cont(acctbal, 0.5) OVER (PARTITION BY c_nationkey)), 4) + 0.0 AS acctbal FROM {GAPPY}""")
def group_median(spark, sf):
    df = gappy_customers(spark, sf)
    med = exact_quantiles(df, ["acctbal"], [0.5], ["c_nationkey"]).select(
        "c_nationkey", F.col("q0").alias("med"), "n_values")
    out = join_lookup(df, med, ["c_nationkey"], "n_values", ["c_custkey"])
    return out.select("c_custkey", rounded(F.coalesce("acctbal", "med")).alias("acctbal"))


@plan("f3_lags", f"""
WITH {PANEL_SQL} SELECT series, {DAY_SQL}, {", ".join(f"round(lag(v, {k}) OVER (PARTITION BY series ORDER BY day), 2) + 0.0 AS y_lag_{k}" for k in (2, 3, 4))} FROM p""")
def lags(spark, sf):
    return dense_panel(spark, sf).select("series", iso_day(), *[
        rounded(c, 2).alias(n) for n, c in P.lag_block("v", 3, KEYS, lead_time=2).items()])


@plan("f4_lead", f"""
WITH {PANEL_SQL} SELECT series, {DAY_SQL}, round(lead(v, 2) OVER (PARTITION BY series ORDER BY day), 2) + 0.0 AS ahead FROM p""")
def leads(spark, sf):
    return dense_panel(spark, sf).select("series", iso_day(), rounded(P.lead("v", 2, KEYS), 2).alias("ahead"))


@plan("f5_differences", f"""
WITH {PANEL_SQL} SELECT series, {DAY_SQL}, round(v - lag(v) OVER w, 2) + 0.0 AS diff,
  round(ln(v) - lag(ln(v)) OVER w, 6) + 0.0 AS log_return, round(ln(1 + v) - lag(ln(1 + v)) OVER w, 6) + 0.0 AS log1p_return
FROM p WINDOW w AS (PARTITION BY series ORDER BY day)""")
def differences(spark, sf):
    return dense_panel(spark, sf).select(
        "series", iso_day(), rounded(P.difference(F.col("v"), KEYS), 2).alias("diff"),
        rounded(P.log_return("v", KEYS), 6).alias("log_return"),
        rounded(P.log_return("v", KEYS, plus_one=True), 6).alias("log1p_return"))


@plan("f6_forward_fill", f"""
WITH {PANEL_SQL} SELECT series, {DAY_SQL}, round(last_value(v IGNORE NULLS) OVER (PARTITION BY series ORDER BY day), 2) + 0.0 AS filled FROM p""")
def forward_fill(spark, sf):
    return dense_panel(spark, sf).select("series", iso_day(), rounded(P.forward_fill("v", KEYS), 2).alias("filled"))


@plan("f7_open_window", f"""
WITH {PANEL_SQL}, q AS (SELECT series, day, CASE WHEN day BETWEEN DATE '1995-03-01' AND DATE '2001-06-01' THEN v END AS v FROM p)
SELECT series, {DAY_SQL}, count(v) OVER (PARTITION BY series ORDER BY day) > 0
  AND count(v) OVER (PARTITION BY series ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) > 0 AS is_open FROM q""")
def open_window(spark, sf):
    inside = F.col("day").between(F.lit("1995-03-01").cast("date"), F.lit("2001-06-01").cast("date"))
    cut = dense_panel(spark, sf).withColumn("v", F.when(inside, F.col("v")))
    return cut.select("series", iso_day(), P.open_window("v", KEYS).alias("is_open"))


@plan("f8_centred_mean", f"""
WITH {PANEL_SQL} SELECT series, {DAY_SQL}, CASE WHEN count(v) OVER w >= 183 THEN round(avg(v) OVER w, 5) + 0.0 END AS smooth
FROM (SELECT series, day, CAST(round(v * 100) AS BIGINT) AS v FROM p) WINDOW w AS (PARTITION BY series ORDER BY day ROWS BETWEEN 182 PRECEDING AND 182 FOLLOWING)""")
def centred_mean(spark, sf):
    cents = dense_panel(spark, sf).withColumn("v", F.round(F.col("v") * 100).cast("bigint"))
    return cents.select("series", iso_day(), rounded(P.centred_mean("v", KEYS), 5).alias("smooth"))


@plan("f9_forward_exposure", f"""
WITH {PANEL_SQL} SELECT series, {DAY_SQL},
  CAST(sum(n) OVER (PARTITION BY series ORDER BY day ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS BIGINT) AS n_0_2,
  CAST(sum(n) OVER (PARTITION BY series ORDER BY day ROWS BETWEEN 8 FOLLOWING AND 14 FOLLOWING) AS BIGINT) AS n_8_14 FROM p""")
def forward_exposure(spark, sf):
    return dense_panel(spark, sf).select("series", iso_day(), P.forward_sum("n", 0, 2, KEYS).alias("n_0_2"),
                                         P.forward_sum("n", 8, 14, KEYS).alias("n_8_14"))


@plan("f10_start_flag", f"""
WITH {PANEL_SQL}, {PROMO_SQL}, q AS (SELECT series, day, coalesce(promo, 0.0) AS b FROM p LEFT JOIN pr USING (series, day))
SELECT series, {DAY_SQL}, coalesce(b - lag(b) OVER (PARTITION BY series ORDER BY day) = 1, false) AS is_start FROM q""")
def start_flag(spark, sf):
    panel = dense_panel(spark, sf).join(promotions(spark, sf), ["series", "day"], "left").na.fill(0.0, ["promo"])
    return panel.select("series", iso_day(), P.start_flag("promo", KEYS).alias("is_start"))


@plan("f11_ranked_dedup", """
SELECT o_custkey, o_orderkey AS closest_order, o_totalprice AS closest_price FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY abs(o_totalprice - 250000), o_orderkey) = 1""")
def ranked_dedup(spark, sf):
    out = keep_one(scan(spark, sf, "orders"), ["o_custkey"],
                   [F.abs(F.col("o_totalprice") - 250000), F.col("o_orderkey")], ["o_orderkey", "o_totalprice"])
    return out.withColumnsRenamed({"o_orderkey": "closest_order", "o_totalprice": "closest_price"})


@plan("f12_plain_dedup", """
SELECT md5(text) AS text_md5, min(doc_id) AS doc_id FROM documents GROUP BY text""")
def plain_dedup(spark, sf):
    docs = scan(spark, sf, "documents").select(F.sha2("text", 256).alias("k"), "doc_id", F.md5("text").alias("text_md5"))
    return keep_one(docs, ["k"], [F.col("doc_id")], ["doc_id", "text_md5"]).drop("k")


@plan("f13_best_lag", f"""
WITH {PANEL_SQL}, k AS (SELECT unnest(range(1, 15)) AS k),
j AS (SELECT a.series, k, a.v AS y, b.v AS x FROM p a, k JOIN p b ON b.series = a.series AND b.day = a.day - CAST(k AS INTEGER)
  WHERE a.v IS NOT NULL AND b.v IS NOT NULL),
c AS (SELECT series, k, covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0) AS c FROM j GROUP BY ALL)
SELECT series, CAST(k AS INTEGER) AS best_lag, round(c, 6) + 0.0 AS corr FROM c
QUALIFY row_number() OVER (PARTITION BY series ORDER BY abs(c) DESC, k) = 1""")
def best_lag(spark, sf):
    lagged = dense_panel(spark, sf).select("series", "v", *[
        c.alias(n) for n, c in P.lag_block("v", 14, KEYS).items()])
    long = lagged.select("series", F.col("v").alias("y"), F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col(f"y_lag_{k}").alias("x")) for k in range(1, 15)])).alias("s"))
    corr = long.groupBy("series", "s.k").agg(guarded_corr(F.col("s.x"), F.col("y")).alias("corr"))
    best = keep_one(corr.where(F.col("corr").isNotNull()), ["series"], [-F.abs("corr"), F.col("k")], ["k", "corr"])
    return best.select("series", F.col("k").alias("best_lag"), rounded("corr", 6).alias("corr"))


@plan("f14_minimum_gap", f"""
WITH RECURSIVE d AS (SELECT DISTINCT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_totalprice > 450000),
k AS (SELECT series, min(day) AS day FROM d GROUP BY series UNION ALL
      SELECT k.series, (SELECT min(d.day) FROM d WHERE d.series = k.series AND d.day >= k.day + 7) FROM k WHERE k.day IS NOT NULL)
SELECT series, {DAY_SQL} FROM k WHERE day IS NOT NULL""")
def minimum_gap(spark, sf):
    events = scan(spark, sf, "orders").where(F.col("o_totalprice") > 450000).select(
        F.col("o_orderpriority").alias("series"), F.to_date("o_orderdate").alias("day"))
    return P.thin_by_gap(events, KEYS, "day", 7).select("series", iso_day())


@plan("f15_average_rank", """
SELECT p_partkey, rank() OVER (ORDER BY p_size) + (count(*) OVER (PARTITION BY p_size) - 1) / 2.0::DOUBLE AS size_rank FROM part""")
def average_rank(spark, sf):
    return average_ranks(scan(spark, sf, "part", ["p_partkey", "p_size"]), "p_size", "size_rank").select("p_partkey", "size_rank")
