"""Aggregation, profile and audit plans."""

from pyspark.sql import functions as F

from panelwright.operators import profile as P
from panelwright.operators.scale import exact_quantiles
from panelwright.plans.expressions import GAPPY, gappy_customers
from panelwright.plans.registry import plan, rounded
from panelwright.sources.tables import scan


@plan("e1_group_aggregate", """
SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_orderkey) AS n_orders,
       round(sum(l_quantity), 2) + 0.0 AS sum_qty, round(avg(l_extendedprice), 4) + 0.0 AS avg_price,
       round(quantile_cont(l_extendedprice, 0.5), 4) + 0.0 AS median_price FROM lineitem GROUP BY ALL""")
def group_aggregate(spark, sf):
    li, keys = scan(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"]
    plain = li.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("l_orderkey").alias("n_orders"),
        rounded(F.sum("l_quantity"), 2).alias("sum_qty"), rounded(F.avg("l_extendedprice")).alias("avg_price"))
    median = exact_quantiles(li, ["l_extendedprice"], [0.5], keys)
    return plain.join(median, keys).select(*plain.columns, rounded("q0").alias("median_price"))


@plan("e2_group_range", """
SELECT o_custkey, round(max(o_totalprice) - min(o_totalprice), 2) + 0.0 AS price_range FROM orders GROUP BY o_custkey""")
def group_range(spark, sf):
    return scan(spark, sf, "orders").groupBy("o_custkey").agg(
        rounded(F.max("o_totalprice") - F.min("o_totalprice"), 2).alias("price_range"))


@plan("e3_roll_up_level", """
WITH s AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus, o_orderpriority, sum(o_totalprice) AS v FROM orders GROUP BY ALL)
SELECT strftime(day, '%Y-%m-%d') AS day, o_orderstatus, round(sum(v), 2) + 0.0 AS total FROM s GROUP BY day, o_orderstatus""")
def roll_up(spark, sf):
    series = scan(spark, sf, "orders").groupBy(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderstatus", "o_orderpriority").agg(
        F.sum("o_totalprice").alias("v"))
    return series.groupBy("day", "o_orderstatus").agg(rounded(F.sum("v"), 2).alias("total"))


@plan("e4_global_statistics", f"""
SELECT round(avg(acctbal), 4) + 0.0 AS mean, round(quantile_cont(acctbal, 0.5), 4) + 0.0 AS median,
       (SELECT segment FROM {GAPPY} WHERE segment IS NOT NULL GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1) AS mode,
       round(stddev_samp(acctbal), 4) + 0.0 AS std, round(avg(CAST(acctbal > 5000 AS INTEGER)), 6) + 0.0 AS rate FROM {GAPPY}""")
def global_statistics(spark, sf):
    df = gappy_customers(spark, sf)
    stats = df.agg(rounded(F.avg("acctbal")).alias("mean"), rounded(F.stddev_samp("acctbal")).alias("std"),
                   rounded(F.avg((F.col("acctbal") > 5000).cast("int")), 6).alias("rate"))
    median = exact_quantiles(df, ["acctbal"], [0.5]).select(rounded("q0").alias("median"))
    mode = P.categorical_profile(df, ["segment"]).select(F.col("top").alias("mode"))
    return stats.join(F.broadcast(median)).join(F.broadcast(mode))  # one row each


@plan("e5_value_counts", """
SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 25""")
def counts(spark, sf):
    return P.value_counts(scan(spark, sf, "orders"), "o_custkey", 25)


PROFILE_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _profile_sql(c):
    qs = ", ".join(f"round(quantile_cont({c}, {p}), 4) + 0.0 AS q{i}" for i, p in enumerate((.25, .5, .75, .9, .99, .999)))
    return f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) + 0.0 AS mean, round(stddev_samp({c}), 4) + 0.0 AS std,
      min({c}) AS min, max({c}) AS max, {qs} FROM lineitem"""


@plan("e6_numeric_profile", " UNION ALL ".join(_profile_sql(c) for c in PROFILE_COLUMNS))
def numeric_profile(spark, sf):
    probs = (.25, .5, .75, .9, .99, .999)
    out = P.numeric_profile(scan(spark, sf, "lineitem"), PROFILE_COLUMNS, probs)
    return out.select("column", "n", rounded("mean").alias("mean"), rounded("std").alias("std"), "min", "max",
                      *[rounded(f"q{i}").alias(f"q{i}") for i in range(len(probs))])


@plan("e7_categorical_profile", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS n, count(DISTINCT {c}) AS n_levels,
       (SELECT {c} FROM part GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
       (SELECT count(*) FROM part GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS freq FROM part"""
                                              for c in ("p_name", "p_brand", "p_type")))
def categorical_profile(spark, sf):
    return P.categorical_profile(scan(spark, sf, "part"), ["p_name", "p_brand", "p_type"])


@plan("e8_missing_audit", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count(*) - count({c}) AS n_missing, round((count(*) - count({c})) / count(*), 6) + 0.0 AS ratio FROM {GAPPY}"""
                                        for c in ("c_custkey", "c_nationkey", "acctbal", "segment", "name")))
def missing(spark, sf):
    return P.missing_audit(gappy_customers(spark, sf)).select("column", "n_missing", rounded("ratio", 6).alias("ratio"))


@plan("e9_duplicate_audit", """
SELECT 'document_text' AS what, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct, CAST(sum(n - 1) AS BIGINT) AS n_duplicates,
       count(*) FILTER (WHERE n > 1) AS n_repeated_keys, max(n) AS largest_group FROM (SELECT count(*) AS n FROM documents GROUP BY text)
UNION ALL
SELECT 'lineitem_key', CAST(sum(n) AS BIGINT), count(*), CAST(sum(n - 1) AS BIGINT), count(*) FILTER (WHERE n > 1), max(n)
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def duplicates(spark, sf):
    texts = P.duplicate_audit(scan(spark, sf, "documents"), ["text"], digest=True)
    keys = P.duplicate_audit(scan(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return texts.withColumn("what", F.lit("document_text")).unionByName(keys.withColumn("what", F.lit("lineitem_key")))


@plan("e10_range_audit", """
SELECT 'price_not_negative' AS rule, count(*) FILTER (WHERE l_extendedprice < 0) AS n_violations, count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'discount_in_range', count(*) FILTER (WHERE l_discount NOT BETWEEN 0 AND 0.08), count(*) FROM lineitem
UNION ALL SELECT 'quantity_in_range', count(*) FILTER (WHERE l_quantity NOT BETWEEN 1 AND 40), count(*) FROM lineitem""")
def ranges(spark, sf):
    return P.range_audit(scan(spark, sf, "lineitem"), {
        "price_not_negative": F.col("l_extendedprice") >= 0, "discount_in_range": F.col("l_discount").between(0, 0.08),
        "quantity_in_range": F.col("l_quantity").between(1, 40)})


@plan("e11_crosstab", """
SELECT o_orderpriority, count(*) FILTER (WHERE l_returnflag = 'A') AS A, count(*) FILTER (WHERE l_returnflag = 'N') AS N,
       count(*) FILTER (WHERE l_returnflag = 'R') AS R FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderpriority""")
def crosstab(spark, sf):
    j = scan(spark, sf, "orders").join(scan(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return P.crosstab(j, "o_orderpriority", "l_returnflag", ["A", "N", "R"])


@plan("e12_margins", """
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(grouping(l_returnflag) * 2 + grouping(l_linestatus) AS INTEGER) AS level
FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def margins(spark, sf):
    return P.margins(scan(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@plan("e12_expected_counts", """
WITH c AS (SELECT l_returnflag, l_linestatus, count(*) AS o FROM lineitem GROUP BY ALL)
SELECT l_returnflag, l_linestatus, o AS observed, round(sum(o) OVER (PARTITION BY l_returnflag)
  * sum(o) OVER (PARTITION BY l_linestatus) / sum(o) OVER (), 4) + 0.0 AS expected FROM c""")
def expected(spark, sf):
    return P.contingency(scan(spark, sf, "lineitem"), "l_returnflag", "l_linestatus").select(
        "l_returnflag", "l_linestatus", "observed", rounded("expected").alias("expected"))


@plan("e13_histogram", """
WITH r AS (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part),
h AS (SELECT least(floor((p_retailprice - lo) / ((hi - lo) / 30)), 29) AS b, count(*) AS n FROM part, r GROUP BY b)
SELECT CAST(i AS INTEGER) AS bin, round(lo + i * ((hi - lo) / 30), 4) + 0.0 AS lower, round(lo + (i + 1) * ((hi - lo) / 30), 4) + 0.0 AS upper,
       coalesce(n, 0) AS n FROM (SELECT unnest(range(0, 30)) AS i) g CROSS JOIN r LEFT JOIN h ON h.b = g.i""")
def histogram(spark, sf):
    part = scan(spark, sf, "part")
    out = P.histogram(part, "p_retailprice", 30, *P.column_range(part, "p_retailprice"))
    return out.select("bin", rounded("lower").alias("lower"), rounded("upper").alias("upper"), "n")


def _outlier_sql(c):
    return f"""SELECT '{c}' AS "column", n AS n_values, round(m - 3 * s, 2) + 0.0 AS gauss_lower, round(m + 3 * s, 2) + 0.0 AS gauss_upper,
      (SELECT count(*) FROM lineitem WHERE {c} < m - 3 * s OR {c} > m + 3 * s) AS gauss_out,
      round(a - 1.5 * (b - a), 2) + 0.0 AS iqr_lower, round(b + 1.5 * (b - a), 2) + 0.0 AS iqr_upper,
      (SELECT count(*) FROM lineitem WHERE {c} < a - 1.5 * (b - a) OR {c} > b + 1.5 * (b - a)) AS iqr_out
      FROM (SELECT count({c}) AS n, avg({c}) AS m, stddev_samp({c}) AS s, quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b FROM lineitem)"""


@plan("e14_outliers", " UNION ALL ".join(_outlier_sql(c) for c in ("l_quantity", "l_extendedprice", "l_discount")))
def outliers(spark, sf):
    out = P.outlier_summary(scan(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return out.select("column", "n_values", "gauss_out", "iqr_out", *[
        rounded(c, 2).alias(c) for c in ("gauss_lower", "gauss_upper", "iqr_lower", "iqr_upper")])


@plan("e15_subset_quantile_edges", """
WITH q AS (SELECT 'positive' AS subset, unnest(range(0, 5)) AS edge, unnest(quantile_cont(l_extendedprice * l_discount, [0, 0.25, 0.5, 0.75, 1])) AS value
           FROM lineitem WHERE l_discount > 0)
SELECT subset, CAST(edge AS INTEGER) AS edge, round(value, 4) + 0.0 AS value FROM q
UNION ALL SELECT 'empty', CAST(unnest(range(0, 5)) AS INTEGER), 0.0 FROM (SELECT count(*) FROM lineitem)""")
def edges(spark, sf):
    li = scan(spark, sf, "lineitem").withColumn("spend", F.col("l_extendedprice") * F.col("l_discount"))
    positive = P.quantile_edges(li, "spend", 4, F.col("l_discount") > 0).withColumn("subset", F.lit("positive"))
    empty = P.quantile_edges(li, "spend", 4, F.col("l_discount") > 1).withColumn("subset", F.lit("empty"))
    return positive.unionByName(empty).select("subset", "edge", rounded("value").alias("value"))


def _shape_sql(c, table):
    m = f"(SELECT avg({c}) FROM {table})"
    return f"""SELECT '{c}' AS "column", round(avg(pow({c} - {m}, 3)) / pow(var_pop({c}), 1.5), 6) + 0.0 AS skewness,
      round(avg(pow({c} - {m}, 4)) / pow(var_pop({c}), 2) - 3, 6) + 0.0 AS kurtosis FROM {table}"""


@plan("e16_shape_statistics", _shape_sql("o_totalprice", "orders") + " UNION ALL " + _shape_sql("o_custkey", "orders"))
def shape(spark, sf):
    out = P.shape_statistics(scan(spark, sf, "orders"), ["o_totalprice", "o_custkey"])
    return out.select("column", rounded("skewness", 6).alias("skewness"), rounded("kurtosis", 6).alias("kurtosis"))


@plan("e17_array_statistics", """
WITH f AS (SELECT label, unnest(embedding) AS v, unnest(range(0, 64)) AS position FROM embeddings)
SELECT CAST(NULL AS INTEGER) AS label, CAST(position AS INTEGER) AS position, round(avg(CAST(v AS DOUBLE)), 6) + 0.0 AS mean,
       round(stddev_pop(CAST(v AS DOUBLE)), 6) + 0.0 AS std FROM f GROUP BY position
UNION ALL SELECT label, CAST(position AS INTEGER), round(avg(CAST(v AS DOUBLE)), 6) + 0.0, round(stddev_pop(CAST(v AS DOUBLE)), 6) + 0.0
FROM f GROUP BY label, position""")
def array_statistics(spark, sf):
    df = scan(spark, sf, "embeddings")
    whole = P.array_statistics(df, "embedding").withColumn("label", F.lit(None).cast("int"))
    out = whole.unionByName(P.array_statistics(df, "embedding", ["label"]))
    return out.select("label", "position", rounded("mean", 6).alias("mean"), rounded("std", 6).alias("std"))


@plan("e18_class_centroids", """
WITH f AS (SELECT label, unnest(embedding) AS v, unnest(range(0, 64)) AS p FROM embeddings),
m AS (SELECT label, p, avg(CAST(v AS DOUBLE)) AS m FROM f GROUP BY label, p HAVING avg(CAST(v AS DOUBLE)) > 0.01)
SELECT label, round(avg(p // 8), 6) + 0.0 AS row, round(avg(p % 8), 6) + 0.0 AS col, count(*) AS n_active FROM m GROUP BY label""")
def centroids(spark, sf):
    out = P.active_centroids(scan(spark, sf, "embeddings"), "embedding", "label", 8, 0.01)
    return out.select("label", rounded("row", 6).alias("row"), rounded("col", 6).alias("col"), "n_active")


@plan("e19_top_group_rates", """
SELECT source, round(avg(quality), 6) + 0.0 AS rate, count(*) AS n FROM documents JOIN labels USING (doc_id)
GROUP BY source ORDER BY avg(quality) DESC, source LIMIT 20""")
def rates(spark, sf):
    df = scan(spark, sf, "documents").join(scan(spark, sf, "labels"), "doc_id")
    return P.group_rates(df, "source", "quality", 20).select("source", rounded("rate", 6).alias("rate"), "n")
