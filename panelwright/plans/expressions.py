"""Projections, filters and numeric expressions."""

from pyspark.sql import functions as F

from panelwright.functions import expr as X
from panelwright.operators.scale import exact_quantiles
from panelwright.plans.registry import plan, rounded
from panelwright.sources.tables import finite_or_null, scan

# The column list, fixed at training time, that B22 aligns to.
FROZEN = ["const_absent", "o_totalprice", "is_open", "extra_absent"]


@plan("b1_drop_columns", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def drop_columns(spark, sf):
    return X.drop_columns(scan(spark, sf, "customer"), ["c_name", "c_mktsegment", "not_there"])


@plan("b2_strip_prefix", "SELECT c_custkey AS custkey, c_acctbal AS acctbal, c_name FROM customer")
def strip_prefix(spark, sf):
    named = scan(spark, sf, "customer").select(
        F.col("c_custkey").alias("num__custkey"), F.col("c_acctbal").alias("scaled__acctbal"), "c_name")
    return X.strip_prefixes(named)


@plan("b3_type_routing", """
SELECT kind, column_name, n_values FROM (
  SELECT 'numeric' AS kind, unnest(['p_partkey', 'p_size', 'p_retailprice']) AS column_name UNION ALL
  SELECT 'text', unnest(['p_name', 'p_brand', 'p_type'])) r, (SELECT count(*) AS n_values FROM part) n""")
def type_routing(spark, sf):
    df = scan(spark, sf, "part")
    numeric, text = X.route_by_type(df)
    counts = df.agg(*[F.count(c).alias(c) for c in numeric + text])
    pairs = [F.struct(F.lit(k).alias("kind"), F.lit(c).alias("column_name"), F.col(c).alias("n_values"))
             for k, cols in (("numeric", numeric), ("text", text)) for c in cols]
    return counts.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


@plan("b4_name_routing", """
SELECT o_orderkey, o_totalprice + o_custkey AS numeric_sum,
       CASE WHEN o_orderstatus IN ('F', 'O') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS dummy_sum,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS event_sum FROM orders""")
def name_routing(spark, sf):
    df = scan(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("trend_price"), F.col("o_custkey").alias("trend_cust"),
        (F.col("o_orderstatus") == "F").cast("double").alias("s(1)"),
        (F.col("o_orderstatus") == "O").cast("double").alias("s(2)"),
        (F.col("o_orderpriority") == "1-URGENT").cast("double").alias("urgent"))
    groups = X.route_by_name(df.columns[1:], contains=["trend"], prefixes=["s("])
    return df.select("o_orderkey", *[
        X.row_sum([f"`{c}`" for c in cols]).alias(f"{g}_sum") for g, cols in groups.items()])


@plan("b5_filter", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderstatus IN ('F', 'O') AND o_totalprice BETWEEN 50000 AND 200000
  AND NOT o_orderpriority = '5-LOW' AND o_orderdate IS NOT NULL""")
def filter_rows(spark, sf):
    return scan(spark, sf, "orders").where(
        F.col("o_orderstatus").isin("F", "O") & F.col("o_totalprice").between(50000, 200000)
        & ~(F.col("o_orderpriority") == "5-LOW") & F.col("o_orderdate").isNotNull()
    ).select("o_orderkey", "o_totalprice")


@plan("b6_conditional_update", """
SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'large'
                        WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'rush' ELSE o_orderpriority END AS kind
FROM orders""")
def conditional_update(spark, sf):
    kind = X.update_where(F.col("o_orderpriority"), [
        (F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("rush")),
        (F.col("o_totalprice") > 400000, F.lit("large"))])
    return scan(spark, sf, "orders").select("o_orderkey", kind.alias("kind"))


@plan("b7_casts", """
SELECT p_partkey, CAST(p_size AS VARCHAR) AS size_text, TRY_CAST(p_brand AS BIGINT) AS brand_number,
       TRY_CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS brand_code,
       CAST(p_retailprice > 1000 AS INTEGER) AS is_dear FROM part""")
def casts(spark, sf):
    return scan(spark, sf, "part").select(
        "p_partkey", F.col("p_size").cast("string").alias("size_text"),
        F.col("p_brand").try_cast("bigint").alias("brand_number"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("")).try_cast("bigint").alias("brand_code"),
        (F.col("p_retailprice") > 1000).cast("int").alias("is_dear"))


def gappy_customers(spark, sf):
    """Customers with NULLs induced by a rule that the oracles repeat."""
    return scan(spark, sf, "customer").select(
        "c_custkey", "c_nationkey",
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("acctbal"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_custkey") % 11 != 0, F.col("c_name")).alias("name"))


GAPPY = """(SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS acctbal,
  CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS segment,
  CASE WHEN c_custkey % 11 <> 0 THEN c_name END AS name FROM customer)"""


@plan("b8_null_flags", f"""
SELECT c_custkey, CAST(acctbal IS NULL AS INTEGER) AS acctbal_na, CAST(segment IS NULL AS INTEGER) AS segment_na
FROM {GAPPY}""")
def null_flags(spark, sf):
    return gappy_customers(spark, sf).select(
        "c_custkey", X.null_flag("acctbal").alias("acctbal_na"), X.null_flag("segment").alias("segment_na"))


@plan("b9_constant_fill", f"""
SELECT c_custkey, c_nationkey, coalesce(acctbal, -1.0) AS acctbal, coalesce(segment, 'Missing') AS segment,
       coalesce(name, '__none__') AS name FROM {GAPPY}""")
def constant_fill(spark, sf):
    return gappy_customers(spark, sf).na.fill({"acctbal": -1.0, "segment": "Missing", "name": "__none__"})


@plan("b10_sentinel_to_null", """
SELECT l_orderkey, l_linenumber, nullif(l_discount, 0.0) AS discount,
       CASE WHEN l_tax = 0.0 THEN NULL ELSE round(l_discount / l_tax, 6) + 0.0 END AS ratio,
       count(*) AS n FROM lineitem GROUP BY ALL""")
def sentinel(spark, sf):
    # float division gives inf or NaN for a zero tax, as in numpy; both become NULL
    inf = F.lit(float("inf"))
    ratio = F.when(F.col("l_tax") == 0, F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(inf)) \
        .otherwise(F.try_divide("l_discount", "l_tax"))
    return scan(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", X.sentinel_to_null(F.col("l_discount"), 0.0).alias("discount"),
        rounded(finite_or_null(ratio), 6).alias("ratio")
    ).groupBy("l_orderkey", "l_linenumber", "discount", "ratio").agg(F.count(F.lit(1)).alias("n"))


@plan("b11_drop_null_rows", f"""
SELECT c_custkey, acctbal, segment, 'any' AS how FROM {GAPPY} WHERE acctbal IS NOT NULL AND segment IS NOT NULL
UNION ALL
SELECT c_custkey, acctbal, segment, 'all' FROM {GAPPY} WHERE acctbal IS NOT NULL OR segment IS NOT NULL""")
def drop_nulls(spark, sf):
    df = gappy_customers(spark, sf).select("c_custkey", "acctbal", "segment")
    cols = ["acctbal", "segment"]
    return df.na.drop("any", subset=cols).withColumn("how", F.lit("any")).unionByName(
        df.na.drop("all", subset=cols).withColumn("how", F.lit("all")))


@plan("b12_row_sum", """
SELECT l_orderkey, l_linenumber, round(sum(coalesce(nullif(l_discount, 0.0), 0) + l_tax + l_quantity), 4) + 0.0 AS total
FROM lineitem GROUP BY ALL""")
def row_total(spark, sf):
    df = scan(spark, sf, "lineitem").withColumn("disc", F.nullif("l_discount", F.lit(0.0)))
    return df.withColumn("t", X.row_sum(["disc", "l_tax", "l_quantity"])).groupBy(
        "l_orderkey", "l_linenumber").agg(rounded(F.sum("t")).alias("total"))


@plan("b13_cross_series_median", """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS series, sum(o_totalprice) AS v
           FROM orders GROUP BY ALL)
SELECT strftime(day, '%Y-%m-%d') AS day, round(quantile_cont(v, 0.5), 4) + 0.0 AS median_v,
       round(avg(v), 4) + 0.0 AS mean_v, count(*) AS n_series FROM d GROUP BY day""")
def cross_series(spark, sf):
    daily = scan(spark, sf, "orders").groupBy(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_orderpriority").alias("series")
    ).agg(F.sum("o_totalprice").alias("v"))
    med = exact_quantiles(daily, ["v"], [0.5], ["day"]).select("day", rounded("q0").alias("median_v"))
    mean = daily.groupBy("day").agg(rounded(F.avg("v")).alias("mean_v"), F.count(F.lit(1)).alias("n_series"))
    return mean.join(med, "day")


@plan("b14_guarded_ratio", """
SELECT l_discount, l_tax, round(CASE WHEN l_discount + l_tax > 0 THEN l_discount / (l_discount + l_tax) ELSE 0 END, 6) + 0.0
       AS discount_share, count(*) AS n FROM lineitem GROUP BY ALL""")
def ratio(spark, sf):
    share = X.guarded_ratio(F.col("l_discount"), F.col("l_discount") + F.col("l_tax"))
    return scan(spark, sf, "lineitem").groupBy("l_discount", "l_tax", rounded(share, 6).alias("discount_share")).agg(
        F.count(F.lit(1)).alias("n"))


@plan("b15_clip", f"""
SELECT c_custkey, CASE WHEN acctbal IS NOT NULL THEN least(greatest(acctbal, 0.0), 5000.0) END AS clipped FROM {GAPPY}""")
def clipped(spark, sf):
    return gappy_customers(spark, sf).select("c_custkey", X.clip(F.col("acctbal"), 0.0, 5000.0).alias("clipped"))


@plan("b16_math_transforms", """
SELECT p_partkey, round(ln(1 + p_retailprice), 8) + 0.0 AS log1p, round(exp(least(p_size / 10.0, 20.0)) - 1, 6) + 0.0 AS expm1,
       round(1.0 / (p_retailprice + 0.01), 8) + 0.0 AS inverse, round(sqrt(p_retailprice), 8) + 0.0 AS sqrt,
       round(p_retailprice * p_retailprice, 4) + 0.0 AS square, round(cbrt(p_retailprice), 8) + 0.0 AS cuberoot,
       CAST(abs(p_size - 25) AS INTEGER) AS abs_size FROM part""")
def transforms(spark, sf):
    x = F.col("p_retailprice")
    names = [("log1p", 8), ("inverse", 8), ("sqrt", 8), ("square", 4), ("cuberoot", 8)]
    return scan(spark, sf, "part").select(
        "p_partkey", *[rounded(X.TRANSFORMS[n](x), d).alias(n) for n, d in names],
        rounded(F.expm1(X.clip(F.col("p_size") / 10.0, upper=20.0)), 6).alias("expm1"),
        F.abs(F.col("p_size") - 25).alias("abs_size"))


LAMBDAS = [i / 4 for i in range(-8, 9)]


@plan("b17_power_likelihood", """
WITH g AS (SELECT unnest(range(-8, 9)) / 4.0 AS lam),
t AS (SELECT lam, CASE WHEN lam = 0 THEN ln(o_totalprice) ELSE (pow(o_totalprice, lam) - 1) / lam END AS y,
             ln(o_totalprice) AS j FROM orders, g WHERE o_totalprice > 0)
SELECT CAST(lam AS DOUBLE) AS lambda, round((lam - 1) * sum(j) - count(*) / 2.0 * ln(var_pop(y)), 2) + 0.0 AS log_likelihood
FROM t GROUP BY lam""")
def power_likelihood(spark, sf):
    out = X.power_likelihoods(scan(spark, sf, "orders"), "o_totalprice", LAMBDAS)
    return out.select("lambda", rounded("log_likelihood", 2).alias("log_likelihood"))


@plan("b17_yeo_johnson_fixed", """
SELECT c_custkey, round(CASE WHEN x >= 0 THEN (pow(x + 1, 0.5) - 1) / 0.5 ELSE -(pow(1 - x, 1.5) - 1) / 1.5 END, 6) + 0.0 AS yj
FROM (SELECT c_custkey, c_acctbal - 3000 AS x FROM customer)""")
def yeo_johnson(spark, sf):
    return scan(spark, sf, "customer").select(
        "c_custkey", rounded(X.yeo_johnson(F.col("c_acctbal") - 3000, 0.5), 6).alias("yj"))


@plan("b17_fitted_box_cox")
def fitted_box_cox(spark, sf):
    orders = scan(spark, sf, "orders")
    lam = X.fit_power(orders, "o_totalprice")
    return orders.select("o_orderkey", F.lit(lam).alias("lambda"),
                         X.box_cox(F.col("o_totalprice"), lam).alias("transformed"))


@plan("b18_interaction", """
SELECT l_orderkey, l_linenumber, round(sum(l_quantity * l_discount), 4) + 0.0 AS quantity_x_discount,
       round(sum(l_quantity * l_tax), 4) + 0.0 AS quantity_x_tax FROM lineitem GROUP BY ALL""")
def interaction(spark, sf):
    feats = {f"quantity_x_{c}": F.col("l_quantity") * F.col(f"l_{c}") for c in ("discount", "tax")}
    return scan(spark, sf, "lineitem").withColumns(feats).groupBy("l_orderkey", "l_linenumber").agg(
        *[rounded(F.sum(c)).alias(c) for c in feats])


@plan("b19_categorical_cross", """
SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 9 <> 0 THEN o_orderstatus END, 'Missing') || '_' || o_orderpriority AS crossed
FROM orders""")
def categorical_cross(spark, sf):
    df = scan(spark, sf, "orders").withColumn("st", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderstatus")))
    return df.select("o_orderkey", X.cross("st", "o_orderpriority").alias("crossed"))


# Priority levels; anything else is level 0.
PRIORITY_LEVEL = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "5-LOW": 5}


@plan("b20_literal_map", """
SELECT o_orderkey, lvl AS level, abs(lvl - 3) AS distance_to_mid FROM (
  SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
                     WHEN '5-LOW' THEN 5 ELSE 0 END AS lvl FROM orders)""")
def mapped(spark, sf):
    level = X.literal_map(F.col("o_orderpriority"), PRIORITY_LEVEL, 0)
    return scan(spark, sf, "orders").select("o_orderkey", level.alias("level")).withColumn(
        "distance_to_mid", F.abs(F.col("level") - 3))


@plan("b21_domain_flags", """
SELECT l_quantity, l_discount, CAST(l_quantity <= 10 AND l_discount > 0.05 AS INTEGER) AS small_promo,
       CAST(l_quantity = 1 AS INTEGER) AS single, count(*) AS n FROM lineitem GROUP BY ALL""")
def domain_flags(spark, sf):
    q, d = F.col("l_quantity"), F.col("l_discount")
    return scan(spark, sf, "lineitem").groupBy(
        "l_quantity", "l_discount", ((q <= 10) & (d > 0.05)).cast("int").alias("small_promo"),
        (q == 1).cast("int").alias("single")).agg(F.count(F.lit(1)).alias("n"))


@plan("b22_align_columns", """
SELECT o_orderkey, 0.0::DOUBLE AS const_absent, o_totalprice,
       CASE WHEN o_orderstatus = 'O' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_open,
       0.0::DOUBLE AS extra_absent FROM orders""")
def aligned(spark, sf):
    df = scan(spark, sf, "orders").withColumn("is_open", (F.col("o_orderstatus") == "O").cast("double"))
    return X.align_columns(df, ["o_orderkey", *FROZEN])


@plan("b23_key_match", "SELECT o_orderkey, o_totalprice FROM orders WHERE CAST(o_custkey AS VARCHAR) = '8'")
def key_match(spark, sf):
    return X.match_key(scan(spark, sf, "orders"), "o_custkey", "8").select("o_orderkey", "o_totalprice")
