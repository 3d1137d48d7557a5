"""Split and resample plans."""

from pyspark.sql import functions as F

from panelwright.operators import splits as S
from panelwright.operators.splits import POISSON_ONE
from panelwright.plans.registry import plan, rounded
from panelwright.sources.tables import scan


def hash_sql(key, seed):
    return f"CAST(concat('0x', substr(md5(concat_ws(':', '{seed}', {key})), 1, 8)) AS BIGINT)"


def uniform_sql(key, seed):
    return f"(CAST(concat('0x', substr(md5(concat_ws(':', '{seed}', {key})), 1, 13)) AS BIGINT) / 4503599627370496.0)"


CUST = "CAST(c_custkey AS VARCHAR)"


@plan("k1_random_holdout", f"SELECT c_custkey, {uniform_sql(CUST, 42)} < 0.2 AS is_valid FROM customer")
def holdout(spark, sf):
    return scan(spark, sf, "customer").select("c_custkey", S.holdout(["c_custkey"], 0.2, 42).alias("is_valid"))


NUMBERED = """row_number() OVER (PARTITION BY {label} ORDER BY md5(concat_ws(':', '42', CAST({key} AS VARCHAR))), {key})"""


@plan("k2_stratified_holdout", f"""
SELECT doc_id, quality, {NUMBERED.format(label='quality', key='doc_id')} <= round(count(*) OVER (PARTITION BY quality) * 0.2) AS is_valid FROM labels""")
def stratified(spark, sf):
    df = scan(spark, sf, "labels").select("doc_id", "quality")
    return S.stratified_holdout(df, ["doc_id"], "quality", 0.2, 42)


@plan("k3_stratified_folds", f"""
SELECT doc_id, quality, CAST(({NUMBERED.format(label='quality', key='doc_id')} - 1) % 5 AS INTEGER) AS fold FROM labels""")
def folds(spark, sf):
    return S.stratified_folds(scan(spark, sf, "labels").select("doc_id", "quality"), ["doc_id"], "quality", 5, 42)


@plan("k4_group_folds", f"""
WITH f AS (SELECT CAST({hash_sql('CAST(l_orderkey AS VARCHAR)', 42)} % 10 AS INTEGER) AS fold, CAST(l_returnflag = 'R' AS INTEGER) AS y FROM lineitem)
SELECT fold, count(*) AS n, round(avg(y), 6) + 0.0 AS label_rate FROM f GROUP BY fold""")
def group_folds(spark, sf):
    df = scan(spark, sf, "lineitem").select(S.group_fold(["l_orderkey"], 10, 42).alias("fold"),
                                            (F.col("l_returnflag") == "R").cast("int").alias("y"))
    return S.fold_balance(df, "fold", "y").withColumn("label_rate", rounded("label_rate", 6))


@plan("k4_stratified_group_folds", """
WITH g AS (SELECT l_orderkey, count(*) AS n, sum(CAST(l_returnflag = 'R' AS BIGINT)) AS pos FROM lineitem GROUP BY l_orderkey),
s AS (SELECT *, CAST(least(n, floor(log2(n) * 4) + 16) AS BIGINT) AS sz, CAST(round(pos / n * 20) AS DOUBLE) AS sh FROM g),
f AS (SELECT *, (row_number() OVER (PARTITION BY sz, sh ORDER BY md5(concat_ws(':', '42', CAST(l_orderkey AS VARCHAR))), l_orderkey) - 1
      + CAST(concat('0x', substr(md5(concat_ws(':', '42', CAST(sz AS VARCHAR), CAST(sh AS VARCHAR))), 1, 8)) AS BIGINT)) % 5 AS fold FROM s)
SELECT CAST(fold AS INTEGER) AS fold, CAST(sum(n) AS BIGINT) AS n, round(sum(pos) / sum(n), 6) + 0.0 AS label_rate, count(*) AS n_groups FROM f GROUP BY fold""")
def balanced_group_folds(spark, sf):
    df = scan(spark, sf, "lineitem").select("l_orderkey", (F.col("l_returnflag") == "R").cast("int").alias("y"))
    folds = S.stratified_group_folds(df, ["l_orderkey"], "y", 5, 42)
    return folds.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("y"), 6).alias("label_rate"), F.count_distinct("l_orderkey").alias("n_groups"))


@plan("k5_time_split", """
SELECT CASE WHEN CAST(o_orderdate AS DATE) < DATE '2000-01-01' THEN 'train' ELSE 'valid' END AS part, count(*) AS n,
       round(sum(o_totalprice), 2) + 0.0 AS total FROM orders GROUP BY part""")
def time_split(spark, sf):
    return scan(spark, sf, "orders").groupBy(S.time_split(F.to_date("o_orderdate"), "2000-01-01").alias("part")).agg(
        F.count(F.lit(1)).alias("n"), rounded(F.sum("o_totalprice"), 2).alias("total"))


def _weight_sql(b):
    u = uniform_sql(CUST, f"0.{b}")
    return " + ".join(f"CAST({u} >= {p} AS INTEGER)" for p in POISSON_ONE)


@plan("k6_bootstrap_means", "WITH w AS (SELECT c_acctbal, " + ", ".join(f"{_weight_sql(b)} AS w{b}" for b in range(5)) + " FROM customer) "
      + " UNION ALL ".join(f"SELECT CAST({b} AS INTEGER) AS resample, CAST(sum(w{b}) AS BIGINT) AS n, round(sum(w{b} * c_acctbal) / sum(w{b}), 4) + 0.0 AS mean FROM w"
                           for b in range(5)))
def bootstrap(spark, sf):
    weighted = scan(spark, sf, "customer").select("c_acctbal", F.explode(F.array(*[
        F.struct(F.lit(b).alias("resample"), S.bootstrap_weight(["c_custkey"], b).alias("w")) for b in range(5)])).alias("r"))
    return weighted.groupBy("r.resample").agg(
        F.sum("r.w").alias("n"), rounded(F.try_divide(F.sum(F.col("r.w") * F.col("c_acctbal")), F.sum("r.w"))).alias("mean"))
