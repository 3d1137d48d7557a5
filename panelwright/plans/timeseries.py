"""Panel and time-series plans."""

from pyspark.sql import functions as F

from panelwright.operators import events as E, panel as P, series as S
from panelwright.plans.panels import (DRIVER_SQL, KEYS, PANEL_SQL, PROMO_SQL, dense_panel, driver, observed_panel, promotions)
from panelwright.plans.registry import day_text, plan, rounded
from panelwright.sources.tables import scan


def iso_day():
    return day_text("day").alias("day")


DAY_SQL = "strftime(day, '%Y-%m-%d') AS day"
FILL_SQL = "f AS (SELECT series, day, last_value(v IGNORE NULLS) OVER (PARTITION BY series ORDER BY day) AS v FROM p)"
GUARDED = "covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0)"


def filled_panel(spark, sf):
    return dense_panel(spark, sf).withColumn("v", P.forward_fill("v", KEYS))


@plan("m1_seasonal_profile", """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS v FROM orders GROUP BY ALL)
SELECT CAST(week(day) AS INTEGER) AS period, CAST(isodow(day) - 1 AS INTEGER) AS position, round(avg(v), 4) + 0.0 AS mean FROM d GROUP BY ALL""")
def seasonal(spark, sf):
    total = observed_panel(spark, sf).groupBy("day").agg(F.sum("v").alias("v"))
    return S.seasonal_profile(total, "v", F.weekofyear("day"), F.weekday("day")).withColumn("mean", rounded("mean"))


@plan("m2_periodogram", f"""
WITH {PANEL_SQL}, {FILL_SQL}, i AS (SELECT series, v, row_number() OVER (PARTITION BY series ORDER BY day) - 1 AS t,
  count(*) OVER (PARTITION BY series) AS n FROM f),
r AS (SELECT series, t, n, v - regr_intercept(v, t) OVER w - regr_slope(v, t) OVER w * t AS x FROM i WINDOW w AS (PARTITION BY series)),
k AS (SELECT series, n, k, sum(x * cos(2 * pi() * ((k * t) % n) / n)) AS c, sum(x * sin(2 * pi() * ((k * t) % n) / n)) AS s
  FROM r, (SELECT unnest(range(0, 1300)) AS k) g WHERE k <= n // 2 GROUP BY series, n, k)
SELECT series, round(k * 365.0 / n, 6) + 0.0 AS frequency,
  round((c * c + s * s) / (n * n) * CASE WHEN k = 0 OR 2 * k = n THEN 1 ELSE 2 END, 0) + 0.0 AS power FROM k""")
def periodogram(spark, sf):
    out = S.periodogram(filled_panel(spark, sf), KEYS, "v")
    return out.select("series", rounded("frequency", 6).alias("frequency"), rounded("power", 0).alias("power"))


@plan("m3_lag_correlations", f"""
WITH {PANEL_SQL}, k AS (SELECT unnest(range(1, 9)) AS k),
j AS (SELECT a.series, k, a.v AS y, b.v AS x FROM p a, k JOIN p b ON b.series = a.series AND b.day = a.day - CAST(k AS INTEGER)
  WHERE a.v IS NOT NULL AND b.v IS NOT NULL)
SELECT series, CAST(k AS INTEGER) AS lag, round({GUARDED}, 6) + 0.0 AS corr, count(*) AS n_pairs FROM j GROUP BY ALL""")
def lag_correlations(spark, sf):
    out = S.lag_correlations(dense_panel(spark, sf), KEYS, "v", "v", range(1, 9))
    return out.select("series", "lag", rounded("corr", 6).alias("corr"), "n_pairs")


def cycle(spark, sf):
    return P.global_cycle(filled_panel(spark, sf), KEYS, "v")


CYCLE_SQL = """zs AS (SELECT day, (v - avg(v) OVER (PARTITION BY series)) / nullif(stddev_pop(v) OVER (PARTITION BY series), 0) AS z FROM f),
cy AS (SELECT day, avg(z) AS cycle FROM zs GROUP BY day)"""


@plan("m4_partial_autocorrelation", f"""
WITH {PANEL_SQL}, {FILL_SQL}, {CYCLE_SQL}, c AS (SELECT row_number() OVER (ORDER BY day) AS t, cycle - avg(cycle) OVER () AS x FROM cy),
r AS (SELECT k, sum(a.x * b.x) / (SELECT sum(x * x) FROM c) AS r FROM (SELECT unnest([1, 2]) AS k) g, c a JOIN c b ON b.t = a.t - k GROUP BY k),
q AS (SELECT max(r) FILTER (WHERE k = 1) AS r1, max(r) FILTER (WHERE k = 2) AS r2, (SELECT count(*) FROM c) AS n FROM r)
SELECT 1 AS lag, round(r1, 6) + 0.0 AS pacf, n FROM q UNION ALL SELECT 2, round((r2 - r1 * r1) / (1 - r1 * r1), 6) + 0.0, n FROM q""")
def pacf(spark, sf):
    one = cycle(spark, sf).withColumn("series", F.lit("global"))
    return S.partial_autocorrelations(one, KEYS, "cycle", 2).select("lag", rounded("pacf", 6).alias("pacf"), "n")


@plan("m4_partial_autocorrelation_deep")
def pacf_deep(spark, sf):
    return S.partial_autocorrelations(filled_panel(spark, sf), KEYS, "v", 20)


@plan("m5_cross_correlation", f"""
WITH {PANEL_SQL}, {FILL_SQL}, {CYCLE_SQL}, {DRIVER_SQL},
dg AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM dr),
df AS (SELECT day, last_value(price IGNORE NULLS) OVER (ORDER BY day) AS price FROM dg LEFT JOIN dr USING (day)),
dx AS (SELECT day, ln(price) - lag(ln(price)) OVER (ORDER BY day) AS x FROM df),
xs AS (SELECT date_trunc('week', day) AS t, avg(x) AS x FROM dx GROUP BY t), ys AS (SELECT date_trunc('week', day) AS t, quantile_cont(cycle, 0.5) AS y FROM cy GROUP BY t),
a AS (SELECT row_number() OVER (ORDER BY t) AS i, x, y FROM xs JOIN ys USING (t) WHERE x IS NOT NULL AND y IS NOT NULL),
z AS (SELECT i, (x - avg(x) OVER ()) / stddev_pop(x) OVER () AS x, (y - avg(y) OVER ()) / stddev_pop(y) OVER () AS y, count(*) OVER () AS n FROM a)
SELECT CAST(k AS INTEGER) AS lag, round(sum(b.x * a.y) / max(a.n), 6) + 0.0 AS ccf, max(a.n) AS n
FROM (SELECT unnest(range(-8, 9)) AS k) g, z a JOIN z b ON b.i = a.i + k GROUP BY k""")
def cross_correlation(spark, sf):
    return S.driver_ccf(driver(spark, sf), "price", cycle(spark, sf), "cycle", 8).withColumn("ccf", rounded("ccf", 6))


def residuals(spark, sf):
    """Panel with the value's deviation from its weekday mean, and the order count as a signal."""
    p = dense_panel(spark, sf)
    from pyspark.sql import Window
    return p.withColumn("res", F.col("v") - F.avg("v").over(Window.partitionBy("series", F.weekday("day"))))


RES_SQL = "rs AS (SELECT series, day, v - avg(v) OVER (PARTITION BY series, isodow(day)) AS res, n FROM p)"


@plan("m5_cross_correlation_by_series", f"""
WITH {PANEL_SQL}, {RES_SQL},
i AS (SELECT series, CAST(res AS DOUBLE) AS y, CAST(n AS DOUBLE) AS x, row_number() OVER (PARTITION BY series ORDER BY day) AS t FROM rs WHERE res IS NOT NULL AND n IS NOT NULL),
z AS (SELECT series, t, (x - avg(x) OVER w) / nullif(stddev_pop(x) OVER w, 0) AS x, (y - avg(y) OVER w) / nullif(stddev_pop(y) OVER w, 0) AS y, count(*) OVER w AS n FROM i WINDOW w AS (PARTITION BY series))
SELECT a.series, CAST(k AS INTEGER) AS lag, round(sum(b.x * a.y) / max(a.n), 6) + 0.0 AS ccf, max(a.n) AS n
FROM (SELECT unnest(range(-5, 6)) AS k) g, z a JOIN z b ON b.series = a.series AND b.t = a.t + k GROUP BY a.series, k""")
def cross_correlation_by_series(spark, sf):
    out = S.cross_correlations(residuals(spark, sf), KEYS, "day", "n", "res", 5)
    return out.select("series", "lag", rounded("ccf", 6).alias("ccf"), "n")


@plan("m6_best_lag_summary", f"""
WITH {PANEL_SQL}, {RES_SQL}, ff AS (SELECT series, day, last_value(res IGNORE NULLS) OVER w AS res, last_value(n IGNORE NULLS) OVER w AS n
  FROM rs WINDOW w AS (PARTITION BY series ORDER BY day)),
a AS (SELECT series, day, res, ln(1 + n) - lag(ln(1 + n)) OVER (PARTITION BY series ORDER BY day) AS ret FROM ff),
i AS (SELECT series, res, ret, row_number() OVER (PARTITION BY series ORDER BY day) AS t, count(*) OVER (PARTITION BY series) AS n FROM a WHERE res IS NOT NULL AND ret IS NOT NULL),
j AS (SELECT l.series, k, l.n, r.ret AS x, l.res AS y FROM (SELECT unnest(range(-6, 7)) AS k) g, i l JOIN i r ON r.series = l.series AND r.t = l.t - k),
c AS (SELECT series, k, max(n) AS n, {GUARDED} AS c FROM j GROUP BY ALL)
SELECT series, CAST(k AS INTEGER) AS best_lag, round(c, 6) + 0.0 AS corr, n, round(1.96 / sqrt(n), 6) + 0.0 AS ci95 FROM c
QUALIFY row_number() OVER (PARTITION BY series ORDER BY abs(c) DESC, k) = 1""")
def best_lag_summary(spark, sf):
    out = S.lag_summary(residuals(spark, sf), KEYS, "res", "n", 6)
    return out.select("series", "best_lag", rounded("corr", 6).alias("corr"), "n", rounded("ci95", 6).alias("ci95"))


@plan("m7_ar_by_aic")
def ar_by_aic(spark, sf):
    return S.fit_ar(S.demean(filled_panel(spark, sf), KEYS, ["v"]), KEYS, "v", 7)


@plan("m7_ar_first_order", f"""
WITH {PANEL_SQL}, {FILL_SQL}, c AS (SELECT series, day, v - avg(v) OVER (PARTITION BY series) AS x FROM f),
l AS (SELECT series, x, lag(x) OVER (PARTITION BY series ORDER BY day) AS y FROM c)
SELECT series, round(sum(x * y) / sum(y * y), 6) + 0.0 AS phi FROM l WHERE y IS NOT NULL GROUP BY series""")
def ar_first_order(spark, sf):
    out = S.fit_ar(S.demean(filled_panel(spark, sf), KEYS, ["v"]), KEYS, "v", 1)
    return out.select("series", rounded(F.get("phi", F.lit(0)), 6).alias("phi"))


@plan("m8_ar_filter", f"""
WITH {PANEL_SQL}, {FILL_SQL}, c AS (SELECT series, day, v - avg(v) OVER (PARTITION BY series) AS x FROM f)
SELECT series, {DAY_SQL}, round(x - 0.5 * lag(x, 1) OVER w - 0.2 * lag(x, 2) OVER w, 4) + 0.0 AS filtered FROM c
WINDOW w AS (PARTITION BY series ORDER BY day)""")
def ar_filter(spark, sf):
    c = S.demean(filled_panel(spark, sf), KEYS, ["v"])
    return S.ar_filter(c, KEYS, ["v"], [0.5, 0.2]).select("series", iso_day(), rounded("v").alias("filtered"))


def promo_panel(spark, sf):
    return dense_panel(spark, sf).join(promotions(spark, sf), ["series", "day"], "left").na.fill(0.0, ["promo"])


PROMO_PANEL_SQL = "q AS (SELECT p.series, p.day, p.v, coalesce(promo, 0.0) AS promo FROM p LEFT JOIN pr USING (series, day))"


@plan("m9_prewhitened_summary")
def prewhitened(spark, sf):
    res = residuals(spark, sf).join(promotions(spark, sf), ["series", "day"], "left").na.fill(0.0, ["promo"])
    return S.prewhitened_summary(res, KEYS, "res", "promo")


@plan("m10_event_study", f"""
WITH RECURSIVE {PANEL_SQL}, {PROMO_SQL}, {PROMO_PANEL_SQL},
w AS (SELECT series, day, last_value(v IGNORE NULLS) OVER (PARTITION BY series ORDER BY day) AS v,
  promo - lag(promo) OVER (PARTITION BY series ORDER BY day) = 1 AS s FROM q),
st AS (SELECT series, day FROM w WHERE s),
kp AS (SELECT series, min(day) AS day FROM st GROUP BY series UNION ALL
  SELECT kp.series, (SELECT min(st.day) FROM st WHERE st.series = kp.series AND st.day >= kp.day + 7) FROM kp WHERE kp.day IS NOT NULL),
j AS (SELECT kp.series, kp.day, w.day - kp.day AS o, w.v FROM kp JOIN w ON w.series = kp.series AND w.day BETWEEN kp.day - 7 AND kp.day + 14
  WHERE w.v IS NOT NULL),
fu AS (SELECT *, count(*) OVER (PARTITION BY series, day) AS c FROM j)
SELECT series, CAST(o AS INTEGER) AS "offset", round(avg(v), 4) + 0.0 AS mean, count(*) AS n_events FROM fu WHERE c = 22 GROUP BY ALL""")
def event_study(spark, sf):
    return S.event_study(promo_panel(spark, sf), KEYS, "v", "promo").withColumn("mean", rounded("mean"))


@plan("m11_promotion_features", f"""
WITH {PANEL_SQL}, {PROMO_SQL}, {PROMO_PANEL_SQL}
SELECT series, {DAY_SQL}, sum(promo) OVER (w ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS onp_expo_0_2,
  sum(promo) OVER (w ROWS BETWEEN 8 FOLLOWING AND 14 FOLLOWING) AS onp_expo_8_14,
  CAST(coalesce(promo - lag(promo) OVER w = 1, false) AS DOUBLE) AS onp_start_lead_0 FROM q WINDOW w AS (PARTITION BY series ORDER BY day)""")
def promotion_features(spark, sf):
    out = P.promotion_features(promo_panel(spark, sf), KEYS, "promo")
    return out.withColumn("day", day_text("day"))


@plan("m12_gap_fill", f"""
WITH {PANEL_SQL}, c AS (SELECT series, day, CASE WHEN day >= DATE '1995-02-01' THEN v END AS v FROM p),
o AS (SELECT *, count(v) OVER (PARTITION BY series ORDER BY day) > 0
  AND count(v) OVER (PARTITION BY series ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) > 0 AS opn,
  quantile_cont(v, 0.5) OVER (PARTITION BY series, isodow(day)) AS md, quantile_cont(v, 0.5) OVER (PARTITION BY series) AS ms FROM c)
SELECT series, {DAY_SQL}, round(coalesce(v, CASE WHEN opn THEN coalesce(md, ms) ELSE 0.0 END), 4) + 0.0 AS v FROM o""")
def gap_fill(spark, sf):
    late = F.col("day") >= F.lit("1995-02-01").cast("date")
    cut = dense_panel(spark, sf).withColumn("v", F.when(late, F.col("v")))
    return P.fill_gaps(cut, KEYS, "v").select("series", iso_day(), rounded("v").alias("v"))


@plan("m13_weekly_driver_features", f"""
WITH {DRIVER_SQL}, dg AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM dr),
df AS (SELECT day, last_value(price IGNORE NULLS) OVER (ORDER BY day) AS price FROM dg LEFT JOIN dr USING (day)),
w AS (SELECT CAST(date_trunc('week', day) + INTERVAL 6 DAY AS DATE) AS week, avg(price) AS lvl FROM df GROUP BY ALL),
r AS (SELECT week, lvl, ln(lvl) - lag(ln(lvl)) OVER (ORDER BY week) AS lr FROM w),
l AS (SELECT week, lag(lr, 2) OVER o AS lr2, lag(lr, 4) OVER o AS lr4, lag(lvl, 2) OVER o AS lvl2, lag(lvl, 4) OVER o AS lvl4 FROM r WINDOW o AS (ORDER BY week)),
od AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT strftime(od.day, '%Y-%m-%d') AS day, round(lr2, 6) + 0.0 AS oil_lr_wlag_2, round(lr4, 6) + 0.0 AS oil_lr_wlag_4,
  round(lvl2, 4) + 0.0 AS oil_lvl_wlag_2, round(lvl4, 4) + 0.0 AS oil_lvl_wlag_4 FROM od ASOF LEFT JOIN l ON od.day >= l.week""")
def weekly_driver(spark, sf):
    days = scan(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    out = P.weekly_driver_features(driver(spark, sf), "price", days, (2, 4))
    return out.select(iso_day(), *[rounded(f"oil_lr_wlag_{k}", 6).alias(f"oil_lr_wlag_{k}") for k in (2, 4)],
                      *[rounded(f"oil_lvl_wlag_{k}").alias(f"oil_lvl_wlag_{k}") for k in (2, 4)])


# Calendar events derived from the orders, so that the table grows with them.
EVENT_NAMES = ["Traslado Navidad", "puente Carnaval", "Black Friday", "Cyber Monday", "Terremoto Manabi", "Mundial de futbol Brasil"]
EVENT_TYPES = ["Holiday", "Transfer", "Bridge", "Work Day", "Event"]
EVENTS_SQL = f"""ev AS (SELECT CAST(o_orderdate AS DATE) AS date, {EVENT_TYPES}[o_orderkey % 5 + 1] AS type,
  ['National', 'Local', 'Regional'][o_orderkey % 3 + 1] AS locale,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Ecuador' ELSE 'Place ' || (o_custkey % 7) END AS locale_name,
  {EVENT_NAMES}[o_orderkey // 3 % 6 + 1] || CASE WHEN o_orderkey % 2 = 0 THEN '+' || (o_orderkey % 9) ELSE '-' || (o_custkey % 5) END AS description,
  o_orderkey % 11 = 0 AS transferred FROM orders),
ce AS (SELECT date, CASE WHEN type IN ('Transfer', 'Bridge') THEN 'Holiday' ELSE type END AS type, locale, locale_name,
  CASE WHEN type = 'Work Day' THEN 'Work Day' ELSE regexp_replace(description, '(?i)^\\s*(Traslado|Puente)\\s+', '') END AS d FROM ev WHERE NOT transferred),
co AS (SELECT *, CAST(coalesce(TRY_CAST(nullif(regexp_extract(d, '([+-]\\d+)$', 1), '') AS INTEGER), 0) AS INTEGER) AS additional,
  trim(regexp_replace(d, '[+-]\\d+$', '')) AS b FROM ce),
c AS (SELECT date, type, locale_name, additional, additional * additional AS additional_squared,
  CASE WHEN locale IN ('Local', 'Regional') THEN locale WHEN b IN ('Cyber Monday', 'Black Friday') THEN 'Shopping Day'
       WHEN b = 'Terremoto Manabi' THEN 'Disaster' WHEN regexp_matches(b, '(?i)Mundial de f[uú]tbol') THEN 'World Cup' ELSE b END AS description FROM co)"""


def raw_events(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")

    def pick(values, index):
        return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)

    offset = F.when(k % 2 == 0, F.concat(F.lit("+"), (k % 9).cast("string"))).otherwise(F.concat(F.lit("-"), (c % 5).cast("string")))
    return scan(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("date"), pick(EVENT_TYPES, k % 5).alias("type"),
        pick(["National", "Local", "Regional"], k % 3).alias("locale"),
        F.when(k % 3 == 0, F.lit("Ecuador")).otherwise(F.concat(F.lit("Place "), (c % 7).cast("string"))).alias("locale_name"),
        F.concat(pick(EVENT_NAMES, F.floor(k / 3) % 6), offset).alias("description"), (k % 11 == 0).alias("transferred"))


@plan("m14_event_cleaner", f"""WITH {EVENTS_SQL} SELECT strftime(date, '%Y-%m-%d') AS date, type, locale_name, description, additional, additional_squared FROM c""")
def event_cleaner(spark, sf):
    return E.clean_events(raw_events(spark, sf)).withColumn("date", day_text("date"))


LEVELS = ["Navidad", "Carnaval", "Shopping Day", "World Cup", "Work Day"]
HOT_SQL = ", ".join(f"CAST(description = '{lv}' AS DOUBLE) AS \"{lv}\"" for lv in LEVELS)
HOT_ORDER = ", ".join(f'"{lv}" DESC' for lv in LEVELS)


@plan("m15_national_matrix", f"""WITH {EVENTS_SQL},
n AS (SELECT date, {HOT_SQL}, CAST(additional AS DOUBLE) AS additional, CAST(additional_squared AS DOUBLE) AS additional_squared FROM c
  WHERE locale_name = 'Ecuador' AND description <> 'Disaster'
  QUALIFY row_number() OVER (PARTITION BY date ORDER BY abs(additional) DESC, additional, {HOT_ORDER}) = 1),
di AS (SELECT date, 1.0::DOUBLE AS "Disaster", CAST(additional AS DOUBLE) AS days_from_dis, CAST(additional_squared AS DOUBLE) AS days_from_dis_squared FROM c
  WHERE description = 'Disaster' QUALIFY row_number() OVER (PARTITION BY date ORDER BY abs(additional) DESC, additional) = 1)
SELECT strftime(date, '%Y-%m-%d') AS date, {", ".join(f'coalesce("{c}", 0.0) AS "{c}"' for c in [*LEVELS, "additional", "additional_squared", "Disaster", "days_from_dis", "days_from_dis_squared"])}
FROM n FULL JOIN di USING (date)""")
def national_matrix(spark, sf):
    return E.national_matrix(E.clean_events(raw_events(spark, sf)), "Ecuador", LEVELS).withColumn("date", day_text("date"))


@plan("m16_local_table", f"""WITH {EVENTS_SQL}
SELECT strftime(date, '%Y-%m-%d') AS date, locale_name AS city, additional, additional_squared, 1.0::DOUBLE AS local_holiday FROM c WHERE description = 'Local'
QUALIFY row_number() OVER (PARTITION BY date, locale_name ORDER BY abs(additional), additional) = 1""")
def local_table(spark, sf):
    return E.local_table(E.clean_events(raw_events(spark, sf))).withColumn("date", day_text("date"))


@plan("m16_regional_table", f"""WITH {EVENTS_SQL}
SELECT DISTINCT strftime(date, '%Y-%m-%d') AS date, locale_name AS state, 1.0::DOUBLE AS regional_holiday FROM c WHERE description = 'Regional'""")
def regional_table(spark, sf):
    return E.regional_table(E.clean_events(raw_events(spark, sf))).withColumn("date", day_text("date"))


@plan("m17_global_cycle", f"WITH {PANEL_SQL}, {FILL_SQL}, {CYCLE_SQL} SELECT {DAY_SQL}, round(cycle, 6) + 0.0 AS cycle FROM cy")
def global_cycle(spark, sf):
    return cycle(spark, sf).select(iso_day(), rounded("cycle", 6).alias("cycle"))
