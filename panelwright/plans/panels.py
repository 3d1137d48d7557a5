"""The order panel that stands in for store sales, as a Spark frame and as SQL."""

from pyspark.sql import functions as F

from panelwright.operators.panel import daily_panel, dense_daily
from panelwright.sources.tables import scan

KEYS = ["series"]

# d: observed days, p: dense grid with NULL gaps
PANEL_SQL = """d AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS v, count(*) AS n
  FROM orders GROUP BY ALL),
g AS (SELECT series, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d GROUP BY series),
p AS (SELECT g.series, g.day, d.v, d.n FROM g LEFT JOIN d USING (series, day))"""


def observed_panel(spark, sf):
    orders = scan(spark, sf, "orders")
    return daily_panel(orders, {"series": F.col("o_orderpriority")}, F.col("o_orderdate"),
                       {"v": F.sum("o_totalprice"), "n": F.count(F.lit(1))})


def dense_panel(spark, sf):
    return dense_daily(observed_panel(spark, sf), KEYS)


# promotion share of a day and priority, binary above half
PROMO_SQL = """pr AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS day,
  CAST(avg(CAST(l_discount > 0.05 AS INTEGER)) > 0.5 AS DOUBLE) AS promo
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)"""


def promotions(spark, sf):
    joined = scan(spark, sf, "orders").join(scan(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return daily_panel(joined, {"series": F.col("o_orderpriority")}, F.col("o_orderdate"),
                       {"promo": (F.avg((F.col("l_discount") > 0.05).cast("int")) > 0.5).cast("double")})


# daily driver with induced gaps and zeros
DRIVER_SQL = """dr AS (SELECT CAST(l_shipdate AS DATE) AS day, avg(l_extendedprice) AS price FROM lineitem
  GROUP BY ALL HAVING date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) % 5 <> 0)"""


def driver(spark, sf):
    daily = daily_panel(scan(spark, sf, "lineitem"), {}, F.col("l_shipdate"), {"price": F.avg("l_extendedprice")})
    return daily.where(F.datediff("day", F.lit("1990-01-01").cast("date")) % 5 != 0)
