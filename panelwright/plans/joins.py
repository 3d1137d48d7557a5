"""Join plans."""

from pyspark.sql import functions as F

from panelwright.functions.calendar import resample_key
from panelwright.operators import joins as J
from panelwright.operators.neighbors import nearest_neighbors
from panelwright.operators.panel import asof_backward
from panelwright.plans.expressions import GAPPY, gappy_customers
from panelwright.plans.panels import DRIVER_SQL, PANEL_SQL, PROMO_SQL, dense_panel, driver, promotions
from panelwright.plans.registry import day_text, plan, rounded
from panelwright.sources.tables import scan


@plan("g1_dimension_join", """
SELECT o_orderkey, c_mktsegment, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey""")
def dimension_join(spark, sf):
    o, c, n = (scan(spark, sf, t) for t in ("orders", "customer", "nation"))
    return o.join(c, o.o_custkey == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left").select(
        "o_orderkey", "c_mktsegment", "n_name")


@plan("g2_many_to_one", """
SELECT l_orderkey, l_linenumber, o_orderdate IS NOT NULL AS matched, coalesce(o_orderpriority, 'none') AS o_orderpriority
FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 3 <> 0) o ON l_orderkey = o_orderkey""")
def many_to_one(spark, sf):
    orders = scan(spark, sf, "orders").where(F.col("o_orderkey") % 3 != 0).select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority")
    out = J.join_many_to_one(scan(spark, sf, "lineitem", ["l_orderkey", "l_linenumber"]), orders, ["l_orderkey"],
                             {"o_orderpriority": "none"})
    return out.select("l_orderkey", "l_linenumber", F.col("o_orderdate").isNotNull().alias("matched"), "o_orderpriority")


@plan("g3_left_join_zero_fill", f"""
WITH {PANEL_SQL}, {PROMO_SQL} SELECT series, strftime(day, '%Y-%m-%d') AS day, coalesce(promo, 0.0) AS promo
FROM p LEFT JOIN pr USING (series, day)""")
def zero_fill(spark, sf):
    out = J.join_fill_zero(dense_panel(spark, sf).select("series", "day"), promotions(spark, sf), ["series", "day"])
    return out.select("series", day_text("day").alias("day"), "promo")


@plan("g4_full_outer_fill", """
WITH a AS (SELECT CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL),
b AS (SELECT CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS low FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY ALL)
SELECT strftime(day, '%Y-%m-%d') AS day, round(coalesce(urgent, 0), 2) + 0.0 AS urgent, round(coalesce(low, 0), 2) + 0.0 AS low
FROM a FULL JOIN b USING (day)""")
def full_outer(spark, sf):
    orders = scan(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))

    def daily(priority, name):
        return orders.where(F.col("o_orderpriority") == priority).groupBy("day").agg(F.sum("o_totalprice").alias(name))

    out = J.outer_fill_zero(daily("1-URGENT", "urgent"), daily("5-LOW", "low"), ["day"])
    return out.select(day_text("day").alias("day"), rounded("urgent", 2).alias("urgent"), rounded("low", 2).alias("low"))


@plan("g5_asof_backward", f"""
WITH {DRIVER_SQL}, w AS (SELECT CAST(date_trunc('week', day) + INTERVAL 6 DAY AS DATE) AS week, avg(price) AS level FROM dr GROUP BY ALL)
SELECT o_orderkey, round(level, 4) + 0.0 AS level FROM orders o ASOF LEFT JOIN w ON CAST(o.o_orderdate AS DATE) >= w.week""")
def asof(spark, sf):
    weekly = driver(spark, sf).groupBy(resample_key(F.col("day"), "W-SUN").alias("week")).agg(F.avg("price").alias("level"))
    orders = scan(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return asof_backward(orders, weekly, [], "day", "week", ["level"]).select("o_orderkey", rounded("level").alias("level"))


@plan("g5_asof_by_key", """
WITH q AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS price FROM orders WHERE o_totalprice > 400000 GROUP BY ALL)
SELECT o_orderkey, price AS last_large FROM orders o ASOF LEFT JOIN q ON o.o_orderpriority = q.series AND CAST(o.o_orderdate AS DATE) >= q.day""")
def asof_by_key(spark, sf):
    rows = scan(spark, sf, "orders").select(F.col("o_orderpriority").alias("series"), F.to_date("o_orderdate").alias("day"),
                                            "o_orderkey", "o_totalprice")
    large = rows.where(F.col("o_totalprice") > 400000).groupBy("series", "day").agg(F.max("o_totalprice").alias("last_large"))
    out = asof_backward(rows.drop("o_totalprice"), large, ["series"], "day", "day", ["last_large"])
    return out.select("o_orderkey", "last_large")


@plan("g6_lookup_default", """
SELECT o_orderkey, coalesce(n, 0) AS segment_count FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN (SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_custkey % 2 = 0 AND c_mktsegment <> 'MACHINERY' GROUP BY ALL) USING (c_mktsegment)""")
def lookup_default(spark, sf):
    cust = scan(spark, sf, "customer")
    fitted = cust.where((F.col("c_custkey") % 2 == 0) & (F.col("c_mktsegment") != "MACHINERY")).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("segment_count")).withColumn("n", F.col("segment_count"))
    orders = scan(spark, sf, "orders")
    rows = orders.join(cust, orders.o_custkey == cust.c_custkey).select("o_orderkey", "c_mktsegment")
    return J.lookup(rows, fitted, ["c_mktsegment"], "segment_count", 0, "n").select("o_orderkey", "segment_count")


@plan("g7_group_lookup_fallback", f"""
WITH t AS (SELECT * FROM {GAPPY} WHERE c_nationkey % 4 <> 0), gm AS (SELECT c_nationkey, segment, quantile_cont(acctbal, 0.5) AS m FROM t
  WHERE acctbal IS NOT NULL GROUP BY ALL)
SELECT c_custkey, round(coalesce(acctbal, m, (SELECT quantile_cont(acctbal, 0.5) FROM t)), 4) + 0.0 AS acctbal
FROM {GAPPY} x LEFT JOIN gm USING (c_nationkey, segment)""")
def fallback(spark, sf):
    df = gappy_customers(spark, sf)
    train = df.where(F.col("c_nationkey") % 4 != 0)
    return J.fill_from_groups(df, train, ["c_nationkey", "segment"], "acctbal").select("c_custkey", rounded("acctbal").alias("acctbal"))


@plan("g8_aligned_inner_join", f"""
WITH {PANEL_SQL}, {DRIVER_SQL} SELECT series, strftime(day, '%Y-%m-%d') AS day, round(v, 2) + 0.0 AS v, round(price, 6) + 0.0 AS price
FROM p JOIN dr USING (day) WHERE v IS NOT NULL AND price IS NOT NULL""")
def aligned(spark, sf):
    out = dense_panel(spark, sf).join(driver(spark, sf), "day").na.drop(subset=["v", "price"])
    return out.select("series", day_text("day").alias("day"), rounded("v", 2).alias("v"), rounded("price", 6).alias("price"))


@plan("g9_semi_join", """
SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def semi(spark, sf):
    keep = scan(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return scan(spark, sf, "orders").join(keep, "o_custkey", "left_semi").select("o_orderkey")


@plan("g10_coverage", """
SELECT (SELECT count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)) AS n_missing,
       (SELECT count(*) FROM (SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer)) AS n_extra""")
def coverage(spark, sf):
    want = scan(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    return J.coverage(want, scan(spark, sf, "orders").select(F.col("o_custkey").alias("k")), ["k"])


@plan("g11_nearest_neighbors", """
SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id, round(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) + 0.0 AS distance,
       CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), b.vec_id) AS INTEGER) AS rank
FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id QUALIFY rank <= 3""")
def knn(spark, sf):
    df = scan(spark, sf, "embeddings")
    out = nearest_neighbors(df, df, "vec_id", "embedding", 3, exclude_self=True)
    return out.withColumn("distance", rounded("distance", 6))


OPEN_SPANS_SQL = """
WITH spans AS (
  SELECT o_orderkey AS span_key, o_orderdate AS opened, max(l_shipdate) AS closed, o_totalprice AS span_value
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderdate, o_totalprice),
pairs AS (
  SELECT o.o_orderkey, sp.span_value FROM orders o JOIN spans sp
  ON o.o_orderdate BETWEEN sp.opened AND sp.closed AND sp.span_key <> o.o_orderkey)
SELECT o.o_orderkey, CAST(count(p.o_orderkey) AS BIGINT) AS n_open, round(coalesce(sum(p.span_value), 0), 2) + 0.0 AS open_value
FROM orders o LEFT JOIN pairs p USING (o_orderkey) GROUP BY o.o_orderkey"""


@plan("g12_interval_join", OPEN_SPANS_SQL)
def open_orders_at_placement(spark, sf):
    """For each order, the other orders open (placed, not yet fully shipped) on its order date, by a bucketed range join."""
    from panelwright.operators.intervals import interval_join

    orders = scan(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    last_ship = scan(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("closed"))
    spans = orders.join(last_ship, orders.o_orderkey == last_ship.l_orderkey).select(
        F.col("o_orderkey").alias("span_key"), F.col("o_orderdate").alias("opened"), "closed", F.col("o_totalprice").alias("span_value"))
    value = F.col("span_value")
    finite = F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value).cast("decimal(28,9)")
    parts = {"n_open": F.lit(1).cast("long"), "finite": finite, **{name: F.when(value == F.lit(float(name)), 1).otherwise(0).cast("long") for name in ("nan", "inf", "-inf")}}
    placed = orders.select("o_orderkey", "o_orderdate").where(F.col("o_orderkey").isNotNull())
    around = interval_join(placed, spans, "o_orderdate", "opened", "closed", 7 * 86400, totals=parts)
    everyone = placed.join(around, "o_orderdate").select("o_orderkey", *parts)
    # an order is open on its own date: its own spans are taken off again
    own = placed.join(spans, (F.col("o_orderkey") == F.col("span_key")) & F.col("o_orderdate").between(F.col("opened"), F.col("closed")))
    own = own.select("o_orderkey", *[(-F.coalesce(c, F.lit(0))).alias(name) for name, c in parts.items()])
    counts = everyone.unionByName(own).groupBy("o_orderkey").agg(*[F.sum(name).alias(name) for name in parts])
    up, down = F.col("`inf`") > 0, F.col("`-inf`") > 0
    total = F.when((F.col("nan") > 0) | (up & down), F.lit(float("nan"))).when(up, F.lit(float("inf"))).when(down, F.lit(float("-inf"))).otherwise(F.col("finite").cast("double"))
    return orders.select("o_orderkey").join(counts.withColumn("open_value", total), "o_orderkey", "left").select(
        "o_orderkey", F.coalesce("n_open", F.lit(0)).cast("long").alias("n_open"), rounded(F.coalesce("open_value", F.lit(0.0)), 2).alias("open_value"))

