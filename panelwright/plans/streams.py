"""Streaming plans over the events table, each checked against its batch result."""

from pyspark.sql import functions as F

from panelwright.plans.registry import plan, rounded
from panelwright.sources.tables import scan
from panelwright.streaming import monitor as S


def event_stream(spark, sf, **limits):
    # the pattern matches a single file as well as a folder of part files
    stream = S.file_stream(spark, f"{sf}/events.parquet*", scan(spark, sf, "events").schema, **limits)
    return stream.withColumn("ts", S.event_time("ts"))


def baseline(spark, sf):
    return S.DriftBaseline("event_type", "value").fit(scan(spark, sf, "events").where(F.dayofmonth("ts") <= 15))


DRIFT_SQL = """WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events WHERE dayofmonth(ts) <= 15),
e AS (SELECT event_type, CAST(least(greatest(floor((value - lo) / ((hi - lo) / 20)), 0), 19) AS INTEGER) AS bin, CAST(ts AS DATE) AS w, dayofmonth(ts) <= 15 AS base FROM events, r),
bl AS (SELECT event_type, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS b FROM e WHERE base GROUP BY event_type),
bb AS (SELECT bin, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS p FROM e WHERE base GROUP BY bin),
ws AS (SELECT w, count(*) AS n FROM e GROUP BY w HAVING CAST(w + 1 AS TIMESTAMP) <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)),
l AS (SELECT ws.w, max(abs(coalesce(c, 0) / CAST(ws.n AS DOUBLE) - coalesce(b, 0))) AS l_infinity FROM ws CROSS JOIN (SELECT DISTINCT event_type FROM e) t
  LEFT JOIN bl USING (event_type) LEFT JOIN (SELECT w, event_type, count(*) AS c FROM e GROUP BY ALL) k ON k.w = ws.w AND k.event_type = t.event_type GROUP BY ws.w),
j AS (SELECT ws.w, coalesce(p, 0) AS p, coalesce(c, 0) / CAST(ws.n AS DOUBLE) AS q FROM ws CROSS JOIN (SELECT unnest(range(0, 20)) AS bin) t
  LEFT JOIN bb USING (bin) LEFT JOIN (SELECT w, bin, count(*) AS c FROM e GROUP BY ALL) k ON k.w = ws.w AND k.bin = t.bin),
s AS (SELECT w, sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2 AS js FROM j GROUP BY w),
o AS (SELECT strftime(ws.w, '%Y-%m-%d') AS window_start, n, l_infinity, js AS js_divergence FROM ws JOIN l USING (w) JOIN s USING (w))"""


def _windows(spark, sf):
    base = baseline(spark, sf)
    return base.distances(S.run_available(base.counts(event_stream(spark, sf), "ts", "1 day", "1 hour"), "drift"))


@plan("o1_windowed_drift", DRIFT_SQL + """
SELECT window_start, n, round(l_infinity, 6) + 0.0 AS l_infinity, round(js_divergence, 6) + 0.0 AS js_divergence FROM o""")
def windowed_drift(spark, sf):
    return _windows(spark, sf).select(S.utc_text("window_start").alias("window_start"), "n",
                                      rounded("l_infinity", 6).alias("l_infinity"), rounded("js_divergence", 6).alias("js_divergence"))


@plan("o2_quality_on_late_labels", """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS window_start, round(avg(CAST((value > 10) = (event_type IN ('click', 'purchase')) AS INTEGER)), 6) + 0.0 AS accuracy, count(*) AS n
FROM events WHERE event_id % 10 < 7 AND event_id % 4 < 3 GROUP BY ALL""")
def late_labels(spark, sf):
    predictions = event_stream(spark, sf).select("event_id", "ts", (F.col("value") > 10).alias("prediction"))
    # labels come 0, 1, 2 or 3 hours later for seven rows in ten; those beyond two hours miss the time bound
    labels = event_stream(spark, sf).where(F.col("event_id") % 10 < 7).select(
        "event_id", (F.col("ts") + F.make_dt_interval(hours=(F.col("event_id") % 4).cast("int"))).alias("labelled_at"),
        F.col("event_type").isin("click", "purchase").alias("label"))
    rows = S.run_available(S.labelled_quality(predictions, labels, "event_id", "ts", "labelled_at", "2 HOURS", "1 hour"), "quality")
    return S.quality_windows(rows, "ts", "1 day").select(
        S.utc_text("window_start").alias("window_start"), rounded("accuracy", 6).alias("accuracy"), "n")


@plan("o3_threshold_alerts", DRIFT_SQL + """
SELECT window_start, 'l_infinity' AS metric, round(l_infinity, 6) + 0.0 AS value FROM o WHERE l_infinity > 0.02
UNION ALL SELECT window_start, 'js_divergence', round(js_divergence, 6) + 0.0 FROM o WHERE js_divergence > 0.01""")
def threshold_alerts(spark, sf):
    fired = S.alerts(_windows(spark, sf), {"l_infinity": 0.02, "js_divergence": 0.01})
    return fired.select(S.utc_text("window_start").alias("window_start"), "metric", rounded("value", 6).alias("value"))


@plan("o4_online_lags", """
SELECT user_id, event_id, value, lag(value, 1) OVER w AS value_lag_1, lag(value, 2) OVER w AS value_lag_2, lag(value, 3) OVER w AS value_lag_3
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def online_lags(spark, sf):
    stream = event_stream(spark, sf, max_bytes=256 << 20).select("user_id", "event_id", "ts", "value")
    late = S.source_lateness(scan(spark, sf, "events").withColumn("ts", S.event_time("ts")), "ts")
    return S.run_online_lags(stream, "user_id", "ts", "event_id", "value", 3, f"{late + 1} seconds")


@plan("o4_timer_lags", """
SELECT user_id, event_id, value, lag(value, 1) OVER w AS value_lag_1, lag(value, 2) OVER w AS value_lag_2, lag(value, 3) OVER w AS value_lag_3
FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def timer_lags(spark, sf):
    """O4 by list and map state with event-time timers; rows Spark would drop as late make it raise."""
    from panelwright.streaming.timers import run_timer_lags

    stream = event_stream(spark, sf, max_bytes=256 << 20).select("user_id", "event_id", "ts", "value")
    late = S.source_lateness(scan(spark, sf, "events").withColumn("ts", S.event_time("ts")), "ts")
    table, dropped = run_timer_lags(stream, "user_id", "ts", "event_id", "value", 3, f"{late + 1} seconds")
    if dropped:
        raise ValueError(f"{dropped} rows came later than the delay allows")
    return table.where(~F.col("late")).drop("late")


SESSIONS_SQL = """
WITH e AS (
  SELECT user_id, ts, value,
         CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh
  FROM events WHERE ts IS NOT NULL),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start,
       strftime(max(ts) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS session_end,
       CAST(count(*) AS BIGINT) AS n_events, round(sum(value), 6) + 0.0 AS total_value
FROM g GROUP BY user_id, sid"""


@plan("o5_event_sessions", SESSIONS_SQL)
def event_sessions(spark, sf):
    """Per-user sessions of events, merged while gaps stay under 30 minutes."""
    from panelwright.operators.intervals import sessions

    found = sessions(scan(spark, sf, "events").withColumn("ts", S.event_time("ts")), "user_id", "ts", "30 minutes", "value")
    stamp = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return found.select("user_id", S.utc_text("session_start", stamp).alias("session_start"), S.utc_text("session_end", stamp).alias("session_end"),
                        "n_events", rounded("total_value", 6).alias("total_value"))

