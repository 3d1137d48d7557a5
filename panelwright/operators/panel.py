"""Long-form daily panels: dense grids, gap filling, lags, rolling windows and as-of values.

A panel has one row per (series, day). Windows partition by series, and a series
holds at most one row per calendar day, so a window partition is bounded by the
length of the calendar however many source rows fall on a day: callers aggregate
to days first, with a map-side combine.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelwright.functions.calendar import resample_key
from panelwright.operators.scale import join_lookup, range_index, value_edges


def daily_panel(df: DataFrame, series: Mapping[str, Column], day: Column, measures: Mapping[str, Column]) -> DataFrame:
    """Aggregate source rows to one row per (series, day)."""
    return df.groupBy(*[c.alias(n) for n, c in series.items()], F.to_date(day).alias("day")).agg(
        *[c.alias(n) for n, c in measures.items()])


def dense_daily(panel: DataFrame, keys: Sequence[str], day: str = "day", shared_calendar: bool = False) -> DataFrame:
    """Insert the missing days of every series as NULL rows, without filling.

    The grid spans each series' own first to last day, or the whole table's if
    ``shared_calendar``.
    """
    keys = list(keys)
    span = panel.groupBy(*keys).agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    if shared_calendar:
        ends = panel.agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
        span = span.select(*keys).join(F.broadcast(ends))
    grid = span.select(*keys, F.explode(F.sequence("_lo", "_hi")).alias(day))
    return grid.join(panel, [*keys, day], "left")


def series_window(keys: Sequence[str], day: str = "day"):
    return Window.partitionBy(*keys).orderBy(day)


def lag_block(value: str, lags: int, keys: Sequence[str], day: str = "day", lead_time: int = 1,
              name: str = "y") -> dict[str, Column]:
    """Lag columns ``<name>_lag_k`` for k = lead_time .. lead_time + lags - 1, all over one window."""
    w = series_window(keys, day)
    return {f"{name}_lag_{k}": F.lag(value, k).over(w) for k in range(lead_time, lead_time + lags)}


def lead(value: str, k: int, keys: Sequence[str], day: str = "day") -> Column:
    return F.lead(value, k).over(series_window(keys, day))


def difference(value: Column, keys: Sequence[str], day: str = "day") -> Column:
    """Change against the previous row of the series."""
    return value - F.lag(value, 1).over(series_window(keys, day))


def log_return(value: str, keys: Sequence[str], day: str = "day", plus_one: bool = False) -> Column:
    """Difference of logs; a zero level counts as missing unless ``plus_one`` uses log(1 + x)."""
    level = F.log1p(value) if plus_one else F.log(F.when(F.col(value) > 0, F.col(value)))
    return difference(level, keys, day)


def forward_fill(value: str, keys: Sequence[str], day: str = "day") -> Column:
    """The last known value up to and including the row."""
    return F.last(value, ignorenulls=True).over(
        series_window(keys, day).rowsBetween(Window.unboundedPreceding, 0))


def open_window(value: str, keys: Sequence[str], day: str = "day") -> Column:
    """True between the first and the last known value of the series."""
    w = series_window(keys, day)
    known = F.col(value).isNotNull().cast("int")
    before = F.max(known).over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = F.max(known).over(w.rowsBetween(0, Window.unboundedFollowing))
    return (before + after) == 2


def centred_mean(value: str, keys: Sequence[str], half: int = 182, min_count: int = 183, day: str = "day") -> Column:
    """Rolling mean over ``2 * half + 1`` rows, NULL below ``min_count`` known values."""
    w = series_window(keys, day).rowsBetween(-half, half)
    return F.when(F.count(value).over(w) >= min_count, F.avg(value).over(w))


def forward_sum(value: str, first: int, last: int, keys: Sequence[str], day: str = "day") -> Column:
    """Sum over the rows ``first..last`` ahead.

    Days beyond the end count as zero; where none of the window exists the
    result is NULL, as with a chain of shifted series.
    """
    return F.sum(value).over(series_window(keys, day).rowsBetween(first, last))


def start_flag(binary: str, keys: Sequence[str], day: str = "day") -> Column:
    """True on a 0 to 1 transition; never on the first row."""
    return F.coalesce(difference(F.col(binary), keys, day) == 1, F.lit(False))


def thin_by_gap(events: DataFrame, keys: Sequence[str], day: str, gap: int) -> DataFrame:
    """Greedy thinning: keep an event if it is at least ``gap`` days after the last kept one.

    The array per series holds distinct days, so the calendar bounds it.
    """
    days = F.array_sort(F.collect_set(day))
    kept = F.aggregate(
        "_days", F.array().cast("array<date>"),
        lambda acc, d: F.when(
            (F.size(acc) == 0) | (F.datediff(d, F.try_element_at(acc, F.lit(-1))) >= gap), F.concat(acc, F.array(d))
        ).otherwise(acc))
    return events.groupBy(*keys).agg(days.alias("_days")).select(*keys, F.explode(kept).alias(day))


def fill_gaps(panel: DataFrame, keys: Sequence[str], value: str, day: str = "day", out: str | None = None) -> DataFrame:
    """Fill a dense panel: weekday median, then series median inside the open window, zero outside.

    Medians run over one series' days (bounded by the calendar), in one shuffle by series.
    """
    out = out or value
    by_weekday = Window.partitionBy(*keys, F.weekday(day))
    by_series = Window.partitionBy(*keys)
    staged = panel.select(
        "*", open_window(value, keys, day).alias("_open"),
        F.percentile(value, 0.5).over(by_weekday).alias("_med_dow"),
        F.percentile(value, 0.5).over(by_series).alias("_med"))
    filled = F.when(F.col(value).isNotNull(), F.col(value)).when(
        F.col("_open"), F.coalesce("_med_dow", "_med")).otherwise(F.lit(0.0))
    return staged.withColumn(out, filled).drop("_open", "_med_dow", "_med")


def zscore(panel: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Standardise values per series with the population deviation; a constant series becomes NULL."""
    w = Window.partitionBy(*keys)
    return panel.withColumns({
        v: (F.col(v) - F.avg(v).over(w)) / F.nullif(F.stddev_pop(v).over(w), F.lit(0.0)) for v in values})


def asof_backward(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
                  values: Sequence[str], edges: Sequence[float] | None = None) -> DataFrame:
    """Attach the latest right-hand values at or before each left row, per key.

    No range join: the distinct left times and the right rows are unioned and the
    last known right row is carried forward. Time is cut into ranges, and the
    value that enters a range is carried over from the ranges before it, so a hot
    key is spread over tasks; repeated left times are joined back by a salted
    lookup. Left rows need not be unique; right times are unique per key.
    """
    keys = list(keys)
    if edges is None:
        edges = value_edges(left.select(_seconds(F.col(left_time)).alias("_s")), "_s")

    def cut(time: str) -> Column:
        return range_index(_seconds(F.col(time)), edges).alias("_range")

    right_type = right.select(F.struct(*values)).schema[0].dataType
    times = left.where(F.col(left_time).isNotNull()).groupBy(*keys, left_time).agg(F.count(F.lit(1)).alias("_n"))
    l = times.select(*keys, cut(left_time), F.col(left_time).alias("_t"), F.lit(1).alias("_side"), "_n",
                     F.lit(None).cast(right_type).alias("_right"))
    r = right.where(F.col(right_time).isNotNull()).select(
        *keys, cut(right_time), F.col(right_time).alias("_t"), F.lit(0).alias("_side"),
        F.lit(0).cast("bigint").alias("_n"), F.struct(*values).alias("_right"))
    merged = l.unionByName(r)
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = merged.groupBy(*keys, "_range").agg(
        F.max_by("_right", F.when(F.col("_side") == 0, F.col("_t"))).alias("_last")
    ).select(*keys, "_range", F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
    order = Window.partitionBy(*keys, "_range").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    local = merged.withColumn("_hit", F.last("_right", ignorenulls=True).over(order)).where(F.col("_side") == 1)
    hit = F.coalesce("_hit", "_carry")
    found = local.join(carried, [*keys, "_range"], "left").select(
        *keys, F.col("_t").alias(left_time), *[hit[v].alias(v) for v in values], "_n")
    return join_lookup(left, found, [*keys, left_time], "_n").select(*left.columns, *values)


def _seconds(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp")).cast("double")


def weekly_driver_features(driver: DataFrame, value: str, days: DataFrame, lag_weeks: Sequence[int] = (78, 80, 84),
                           levels: bool = True, returns: bool = True, rule: str = "W-SUN", prefix: str = "oil",
                           day: str = "day") -> DataFrame:
    """Long-lag weekly levels and log returns of one daily driver series, aligned to days.

    Daily forward fill, weekly mean labelled at the week's end, lags in weeks,
    then the latest closed week at or before each day. ``driver`` and ``days``
    hold one row per day, so the single-partition windows see the calendar only.
    """
    dense = dense_daily(driver.withColumn("_k", F.lit(0)), ["_k"], day)
    weekly = dense.withColumn("_f", forward_fill(value, ["_k"], day)).groupBy(
        "_k", resample_key(F.col(day), rule).alias("week")).agg(F.avg("_f").alias("lvl"))
    weekly = weekly.withColumn("_pos", F.when(F.col("lvl") != 0, F.col("lvl")))
    weekly = weekly.withColumn("_ff", F.log(forward_fill("_pos", ["_k"], "week")))
    weekly = weekly.withColumn("lr", difference(F.col("_ff"), ["_k"], "week"))
    cols = {}
    if returns:
        cols |= {f"{prefix}_lr_wlag_{k}": F.lag("lr", k).over(series_window(["_k"], "week")) for k in lag_weeks}
    if levels:
        cols |= {f"{prefix}_lvl_wlag_{k}": F.lag("lvl", k).over(series_window(["_k"], "week")) for k in lag_weeks}
    lagged = weekly.select("_k", "week", *[c.alias(n) for n, c in cols.items()])
    return asof_backward(days.select(day), lagged.drop("_k"), [], day, "week", list(cols), edges=[])


def promotion_features(panel: DataFrame, keys: Sequence[str], promo: str, day: str = "day",
                       windows: Mapping[str, tuple[int, int]] | None = None) -> DataFrame:
    """Forward exposure counts and the start flag of a binary promotion on a dense panel."""
    windows = windows or {"onp_expo_0_2": (0, 2), "onp_expo_8_14": (8, 14)}
    binary = panel.withColumn("_b", (F.coalesce(F.col(promo), F.lit(0.0)) > 0).cast("double"))
    return binary.select(
        *keys, day,
        *[forward_sum("_b", a, b, keys, day).alias(n) for n, (a, b) in windows.items()],
        start_flag("_b", keys, day).cast("double").alias("onp_start_lead_0"))


def global_cycle(panel: DataFrame, keys: Sequence[str], value: str, day: str = "day") -> DataFrame:
    """Mean over series of the standardised values, per day."""
    return zscore(panel, keys, [value]).groupBy(day).agg(F.avg(value).alias("cycle"))
