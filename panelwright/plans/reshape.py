"""Reshape, set, sort and sample plans."""

from pyspark.sql import functions as F

from panelwright.operators import reshape as R
from panelwright.plans.panels import observed_panel
from panelwright.plans.registry import day_text, plan, rounded
from panelwright.sources.tables import scan

# The series domain, fixed in advance: pivots never discover their columns.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
WIDE_SQL = ", ".join(f"""round(sum(o_totalprice) FILTER (WHERE o_orderpriority = '{p}'), 2) + 0.0 AS "{p}\"""" for p in PRIORITIES)


def wide_panel(spark, sf):
    return R.to_wide(observed_panel(spark, sf), "day", "series", PRIORITIES, "v")


@plan("h1_long_to_wide", f"""
SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day, {WIDE_SQL} FROM orders GROUP BY CAST(o_orderdate AS DATE)""")
def long_to_wide(spark, sf):
    return wide_panel(spark, sf).select(day_text("day").alias("day"), *[rounded(f"`{p}`", 2).alias(p) for p in PRIORITIES])


LONG_SQL = """SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day, o_orderpriority AS series, round(sum(o_totalprice), 2) + 0.0 AS v
FROM orders GROUP BY CAST(o_orderdate AS DATE), o_orderpriority"""


@plan("h2_wide_to_long", LONG_SQL)
def wide_to_long(spark, sf):
    long = R.to_long(wide_panel(spark, sf), ["day"], "series", "v")
    return long.select(day_text("day").alias("day"), "series", rounded("v", 2).alias("v"))


@plan("h3_panel_normaliser", f"SELECT *, 'wide' AS shape FROM ({LONG_SQL}) UNION ALL SELECT *, 'long' FROM ({LONG_SQL})")
def normaliser(spark, sf):
    wide = R.normalise_panel(wide_panel(spark, sf), "day", "series", "v").withColumn("shape", F.lit("wide"))
    long = R.normalise_panel(observed_panel(spark, sf), "day", "series", "v").withColumn("shape", F.lit("long"))
    return wide.unionByName(long).select(day_text("day").alias("day"), "series", rounded("v", 2).alias("v"), "shape")


SPEARMAN_COLUMNS = ["l_quantity", "l_extendedprice", "net_price", "l_discount"]
NET_SQL = "(SELECT *, l_extendedprice * (1 - l_discount) AS net_price FROM lineitem)"


def priced_lines(spark, sf):
    return scan(spark, sf, "lineitem").withColumn("net_price", F.col("l_extendedprice") * (1 - F.col("l_discount")))


def _ranks_sql(columns, table):
    ranks = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r{i}" for i, c in enumerate(columns))
    return f"SELECT {ranks} FROM {table}"


def spearman_sql(columns, table):
    pairs = " UNION ALL ".join(
        f"SELECT '{columns[i]}' AS a, '{columns[j]}' AS b, covar_pop(r{i}, r{j}) / nullif(stddev_pop(r{i}) * stddev_pop(r{j}), 0) AS rho FROM k"
        for i in range(len(columns)) for j in range(i + 1, len(columns)))
    return f"WITH k AS ({_ranks_sql(columns, table)}), m AS ({pairs})"


@plan("h4_correlated_pairs", spearman_sql(SPEARMAN_COLUMNS, NET_SQL) + """
SELECT a, b, round(rho, 6) + 0.0 AS rho FROM m WHERE abs(rho) > 0.5""")
def pairs(spark, sf):
    li = priced_lines(spark, sf)
    m = R.spearman_matrix(li, SPEARMAN_COLUMNS, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return R.correlated_pairs(m, 0.5).select("a", "b", rounded("rho", 6).alias("rho"))


@plan("h5_union_all", """
SELECT o_orderkey, o_totalprice, 'train' AS part FROM orders WHERE o_orderkey % 10 < 7
UNION ALL SELECT o_orderkey, o_totalprice, 'test' FROM orders WHERE o_orderkey % 10 >= 5""")
def union_all(spark, sf):
    o, m = scan(spark, sf, "orders", ["o_orderkey", "o_totalprice"]), F.col("o_orderkey") % 10
    return o.where(m < 7).withColumn("part", F.lit("train")).unionByName(o.where(m >= 5).withColumn("part", F.lit("test")))


def _keys(spark, sf):
    return (scan(spark, sf, "customer").select(F.col("c_custkey").alias("k")),
            scan(spark, sf, "orders").where(F.col("o_totalprice") > 200000).select(F.col("o_custkey").alias("k")))


@plan("h6_intersect", "SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders WHERE o_totalprice > 200000")
def intersect(spark, sf):
    a, b = _keys(spark, sf)
    return a.intersect(b)


@plan("h7_except", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 200000")
def except_(spark, sf):
    a, b = _keys(spark, sf)
    return a.subtract(b)


@plan("h8_distinct_keys", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_keys(spark, sf):
    return scan(spark, sf, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@plan("h9_sort", "SELECT c_custkey, c_acctbal FROM customer ORDER BY abs(c_acctbal - 5000) DESC, c_custkey")
def sort(spark, sf):
    return scan(spark, sf, "customer", ["c_custkey", "c_acctbal"]).orderBy(F.abs(F.col("c_acctbal") - 5000).desc(), "c_custkey")


@plan("h10_top_k", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20")
def top_k(spark, sf):
    return scan(spark, sf, "customer", ["c_custkey", "c_acctbal"]).orderBy(F.col("c_acctbal").desc(), "c_custkey").limit(20)


@plan("h11_seeded_sample", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(concat_ws(':', '7', CAST(o_orderkey AS VARCHAR))), o_orderkey LIMIT 500""")
def sample(spark, sf):
    return R.seeded_sample(scan(spark, sf, "orders", ["o_orderkey", "o_totalprice"]), ["o_orderkey"], 500, seed=7)
