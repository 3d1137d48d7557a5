import datetime as dt

from pyspark.sql import functions as F

from panelwright.streaming import monitor as S

SCHEMA = "event_id long, user_id long, ts timestamp_ntz, event_type string, value double"


def write_days(spark, path, days):
    start = dt.datetime(2024, 1, 1)
    rows = [(d * 100 + i, i % 7, start + dt.timedelta(days=d, minutes=13 * i), "ab c"[(i + d) % 3], float((i * 7 + d) % 11))
            for d in range(days) for i in range(100)]
    for d in range(days):  # one file per day, in time order
        spark.createDataFrame([r for r in rows if r[0] // 100 == d], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", S.event_time("ts"))


def test_streamed_drift_equals_batch_on_closed_windows(spark, tmp_path):
    path = str(tmp_path / "events")
    table = write_days(spark, path, 4)
    base = S.DriftBaseline("event_type", "value", 5).fit(table.where("event_id < 200"))
    stream = S.file_stream(spark, path, spark.read.parquet(path).schema, max_files=1).withColumn("ts", S.event_time("ts"))
    got = {r["window_start"]: r for r in base.distances(S.run_available(base.counts(stream, "ts", "1 day", "1 hour"), "t")).collect()}
    want = {r["window_start"]: r for r in base.distances(base.counts(table, "ts", "1 day", "1 hour")).collect()}
    assert len(want) == 4 and len(got) == 3
    for w, r in got.items():
        assert r["n"] == 100 and abs(r["l_infinity"] - want[w]["l_infinity"]) < 1e-12 and abs(r["js_divergence"] - want[w]["js_divergence"]) < 1e-12


def test_drift_with_many_and_absent_levels(spark):
    start = dt.datetime(2024, 1, 1)
    base = spark.range(12_000).selectExpr("if(id < 400, 'top', concat('l', id)) AS event_type", "double(id % 10) AS value")
    rows = [(start, "l500", 1.0), (start, "l501", 2.0), (start, "new", 3.0), (start + dt.timedelta(days=1), "top", 4.0)]
    now = spark.createDataFrame(rows, "ts timestamp, event_type string, value double")
    model = S.DriftBaseline("event_type", "value", 5).fit(base)
    got = [r["l_infinity"] for r in model.distances(model.counts(now, "ts", "1 day", "1 hour")).orderBy("window_start").collect()]
    share = 400 / 12_000
    assert abs(got[0] - 1 / 3) < 1e-9 and abs(got[1] - (1 - share)) < 1e-9
    few = spark.createDataFrame([(start, f"l{i}", 1.0) for i in range(400, 500)], "ts timestamp, event_type string, value double")
    assert abs(model.distances(model.counts(few, "ts", "1 day", "1 hour")).first()["l_infinity"] - share) < 1e-9


def batch_lags(table, n):
    from pyspark.sql import Window
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table.select("event_id", "value", *[F.lag("value", k).over(w).alias(f"l{k}") for k in range(1, n + 1)])
    return {r["event_id"]: tuple(r)[1:] for r in rows.collect()}


def streamed_lags(spark, path, n, delay):
    stream = S.file_stream(spark, path, spark.read.parquet(path).schema, max_files=1).withColumn("ts", S.event_time("ts"))
    out = S.run_online_lags(stream, "user_id", "ts", "event_id", "value", n, delay)
    rows = [(r["event_id"], (r["value"], *(r[f"value_lag_{k}"] for k in range(1, n + 1)))) for r in out.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def test_online_lags_of_one_file_per_day_with_nulls(spark, tmp_path):
    path, holes = str(tmp_path / "events"), str(tmp_path / "holes")
    table = write_days(spark, path, 3).withColumn("value", F.when(F.col("event_id") % 5 != 2, F.col("value")))
    for d in range(3):
        spark.read.parquet(path).where(f"event_id div 100 = {d}").withColumn("value", F.when(F.col("event_id") % 5 != 2, F.col("value"))).coalesce(1).write.mode("append").parquet(holes)
    assert streamed_lags(spark, holes, 2, "1 hour") == batch_lags(table, 2)


def test_online_lags_of_shuffled_files(spark, tmp_path):
    path, mixed = str(tmp_path / "events"), str(tmp_path / "mixed")
    table = write_days(spark, path, 3)
    for k in range(4):
        spark.read.parquet(path).where(f"event_id * 7 % 4 = {k}").coalesce(1).write.mode("append").parquet(mixed)
    late = S.source_lateness(spark.read.parquet(mixed).withColumn("ts", S.event_time("ts")), "ts")
    assert late > 86_400
    assert streamed_lags(spark, mixed, 3, f"{late + 1} seconds") == batch_lags(table, 3)


def test_online_lags_raise_for_rows_that_come_too_late(spark, tmp_path):
    import pytest
    path, mixed = str(tmp_path / "events"), str(tmp_path / "mixed")
    write_days(spark, path, 4)
    for k in (2, 3, 0):
        spark.read.parquet(path).where(f"event_id div 100 = {k}").coalesce(1).write.mode("append").parquet(mixed)
    with pytest.raises(ValueError, match="late"):
        streamed_lags(spark, mixed, 1, "1 hour")
