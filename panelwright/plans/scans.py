"""Scans, sources and sinks."""

from pyspark.sql import functions as F, types as T

from panelwright.functions.expr import literal_map
from panelwright.operators.scale import numbered_by_hash
from panelwright.plans.registry import day_text, plan
from panelwright.sources import tables as src
from panelwright.sources.scratch import scratch_path


@plan("a1_csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan(spark, sf):
    df = src.scan(spark, sf, "customer")
    path = src.write_csv(df, scratch_path(spark, "csv"))
    return src.read_csv(spark, path, src.csv_schema(df))


@plan("a2_typed_csv_scan", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day, o_totalprice
FROM orders WHERE o_totalprice > 100000""")
def typed_csv_scan(spark, sf):
    df = src.scan(spark, sf, "orders")
    path = src.write_csv(df, scratch_path(spark, "csv"))
    pruned = src.read_csv(spark, path, src.csv_schema(df),
                          ["o_orderkey", "o_orderdate", "o_totalprice"], dates=["o_orderdate"])
    return pruned.where(F.col("o_totalprice") > 100000).select(
        "o_orderkey", day_text("o_orderdate").alias("order_day"), "o_totalprice")


@plan("a3_parquet_scan_sink", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def parquet_round_trip(spark, sf):
    path = scratch_path(spark, "orders")
    src.scan(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"]).write.parquet(path)
    return spark.read.parquet(path).where(F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_custkey", "o_totalprice")


@plan("a4_prediction_sink", "SELECT o_orderkey AS id, o_totalprice AS prediction FROM orders")
def prediction_sink(spark, sf):
    path = src.write_predictions_to_scratch(src.scan(spark, sf, "orders"), "o_orderkey", "o_totalprice")
    return src.read_csv(spark, path, "id bigint, prediction double")


@plan("a5_tolerant_records", """
SELECT url AS record_id,
       CAST(length(CASE WHEN page_id % 3 = 0 THEN html ELSE url END) AS BIGINT) AS payload_chars,
       md5(CASE WHEN page_id % 3 = 0 THEN html ELSE url END) AS payload_md5,
       CAST(CASE WHEN page_id % 2 = 0 THEN page_id ELSE page_id % 10 END AS BIGINT) AS label
FROM pages""")
def tolerant_records(spark, sf):
    raw = src.scan(spark, sf, "pages").select(
        "url",
        F.when(F.col("page_id") % 3 == 0, F.lit("")).otherwise(F.col("url")).alias("img"),
        F.col("html").alias("image"),
        F.when(F.col("page_id") % 2 == 0, F.col("page_id")).otherwise(F.lit(-1)).alias("label"),
        (F.col("page_id") % 10).alias("class"),
    )
    rec = src.tolerant_records(raw, ["img", "image"], ["label", "class"], "url")
    return rec.select(
        "record_id", F.char_length(F.col("payload").cast("string")).cast("long").alias("payload_chars"),
        F.md5("payload").alias("payload_md5"), "label")


@plan("a5_record_files", """
SELECT p_partkey, p_name, p_brand, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part""")
def record_files(spark, sf):
    """Parts written as sharded record files, then read back through the record-file data source."""
    from panelwright.sources import records

    parts = src.scan(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size", F.format_number("p_retailprice", 2).alias("price"))
    path = records.write_records(parts, scratch_path(spark, "records"))
    back = records.read_records(spark, path, "p_partkey long, p_name string, p_brand string, p_size long, price string, _corrupt string")
    return back.where(F.col("_corrupt").isNull()).select(
        "p_partkey", "p_name", "p_brand", "p_size", F.regexp_replace("price", ",", "").cast("double").alias("p_retailprice"))


@plan("a6_training_batches", """
WITH r AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY md5(concat_ws(':', '42', CAST(vec_id AS VARCHAR))), vec_id) - 1 AS p,
         count(*) OVER () AS n
  FROM embeddings)
SELECT vec_id, CAST(p // 32 AS BIGINT) AS batch_id, CAST(p % 32 AS BIGINT) AS position,
       array_to_string(list_transform(range(0, 10), lambda x: CASE WHEN x = label THEN '1' ELSE '0' END), ',') AS one_hot
FROM r WHERE p // 32 < n // 32""")
def training_batches(spark, sf):
    size = 32
    rows = numbered_by_hash(src.scan(spark, sf, "embeddings", ["vec_id", "label"]), ["vec_id"], seed=42,
                            out="row_no", total="n_rows")
    p = F.col("row_no") - 1
    hot = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(9)),
                                   lambda x: F.when(x == F.col("label"), "1").otherwise("0")), ",")
    return rows.where(F.floor(p / size) < F.floor(F.col("n_rows") / size)).select(
        "vec_id", F.floor(p / size).alias("batch_id"), (p % size).alias("position"), hot.alias("one_hot"))


@plan("a7_preview", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def preview(spark, sf):
    return src.scan(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice"]).orderBy("o_orderkey").limit(5)


@plan("a7_schema_report", """
SELECT v.position, v.column_name, v.column_type, n.n_rows
FROM (VALUES (0, 'c_custkey', 'bigint'), (1, 'c_name', 'string'), (2, 'c_nationkey', 'int'),
             (3, 'c_acctbal', 'double'), (4, 'c_mktsegment', 'string')) v(position, column_name, column_type),
     (SELECT count(*) AS n_rows FROM customer) n""")
def schema_report(spark, sf):
    return src.schema_report(src.scan(spark, sf, "customer"))


