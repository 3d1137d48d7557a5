"""Range joins of points and intervals, and gap-merged sessions.

``interval_join`` never compares all pairs. Time is cut into buckets of
``width`` at levels 0, 1, 2, ... whose widths double. Each interval goes to the
lowest level at which it spans at most two buckets and is copied to those
(at most two); each point is copied to its one bucket at every level. The
join is then an equi-join on (keys, level, bucket) with the range test as a
residual condition, and every matching pair meets in exactly one bucket. A
very long interval lands on a high level instead of being copied to many
buckets; a crowded bucket is a skewed join partition, which adaptive execution
splits (the other side's rows of that bucket are copied to each split).
With ``totals`` no pairs are made: in each bucket the intervals are added up in
time order, so that the work grows with the rows and not with the pairs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelwright.operators.scale import running_totals
from panelwright.sources.scratch import materialize


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def interval_join(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, width_seconds: int,
                  keys: Sequence[str] = (), totals: Mapping[str, Column] | None = None) -> DataFrame:
    """Pairs of a point and an interval with ``start <= at <= end`` (and equal ``keys``).

    Columns of both sides are kept (they must not share names other than
    ``keys``). Points or intervals with a null time, and intervals that end
    before they start, match nothing. ``width_seconds`` sets the finest bucket; levels are added up
    to the longest interval found in the data.

    ``totals`` names sums over the intervals that a point lies in; the result is
    then one row per distinct (``keys``, ``at``) of the points with these sums.
    Their columns must be integers or decimals, as sums are added and taken off
    again; a null adds nothing.
    """
    width = width_seconds * 1_000_000
    iv = intervals.withColumn("_s", _micros(F.col(start))).withColumn("_e", _micros(F.col(end)))
    iv = iv.where(F.col("_s").isNotNull() & F.col("_e").isNotNull() & (F.col("_e") >= F.col("_s")))
    longest = iv.agg(F.max(F.col("_e") - F.col("_s"))).first()[0] or 0
    levels = (longest // width).bit_length()
    # the lowest level whose buckets the interval crosses at most once
    span = F.floor((F.col("_e") - F.col("_s")) / F.lit(width)).cast("long")
    level = F.when(span <= 0, 0).otherwise(F.floor(F.log2(span.cast("double"))).cast("int") + 1)
    size = F.lit(width) * F.pow(F.lit(2), F.col("_level")).cast("long")
    placed = iv.withColumn("_level", level).withColumn("_b0", F.floor(F.col("_s") / size)).withColumn("_b1", F.floor(F.col("_e") / size))
    placed = placed.withColumn("_bucket", F.explode(F.sequence(F.col("_b0"), F.col("_b1")))).drop("_b0", "_b1")
    pts = points.withColumn("_p", _micros(F.col(at)))
    copies = pts.where(F.col("_p").isNotNull()).withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    copies = copies.withColumn("_bucket", F.floor(F.col("_p") / (F.lit(width) * F.pow(F.lit(2), F.col("_level")).cast("long"))))
    on = [*keys, "_level", "_bucket"]
    if totals is not None:
        return _totals(copies, placed, at, size, keys, on, totals)
    joined = copies.alias("p").join(placed.alias("i"), on, "inner").where((F.col("i._s") <= F.col("p._p")) & (F.col("p._p") <= F.col("i._e")))
    return joined.drop("_level", "_bucket", "_p", "_s", "_e")


def _totals(copies: DataFrame, placed: DataFrame, at: str, size: Column, keys: Sequence[str], cell: Sequence[str],
            totals: Mapping[str, Column]) -> DataFrame:
    """Sums of the intervals around each point: they start and end as marks on the time line of their bucket."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    values = placed.select(*cell, "_s", "_e", *[F.coalesce(c, F.lit(0)).alias(name) for name, c in totals.items()])
    at_type = copies.schema[at].dataType
    none = F.lit(None).cast(at_type).alias("_at")
    first = F.greatest("_s", F.col("_bucket") * size)
    opens = values.select(*cell, first.alias("_t"), none, *totals)
    closes = values.where(F.col("_e") + 1 < (F.col("_bucket") + 1) * size).select(
        *cell, (F.col("_e") + 1).alias("_t"), none, *[(-F.col(name)).alias(name) for name in totals])
    types = {f.name: f.dataType for f in values.schema.fields}
    marks = copies.select(*cell, F.col("_p").alias("_t"), F.col(at).alias("_at"), *[F.lit(0).cast(types[name]).alias(name) for name in totals])
    line = opens.unionByName(closes).unionByName(marks).where(known).groupBy(*cell, "_t").agg(
        F.max("_at").alias("_at"), *[F.sum(name).alias(name) for name in totals])
    # at most one row per bucket and time, written once as the running sums read it several times
    running = running_totals(materialize(line, "interval-marks"), "_t", list(totals), cell)
    return running.where(F.col("_at").isNotNull()).groupBy(*keys, F.col("_at").alias(at)).agg(
        *[F.sum(f"cum_{name}").alias(name) for name in totals])


def sessions(events: DataFrame, key: str, time: str, gap: str, value: str) -> DataFrame:
    """key, session_start, session_end (last event plus the gap), n_events, total_value: gap-merged sessions.

    Rows without a time are left out. The stream form is ``stream_sessions``.
    """
    window = F.session_window(F.col(time), gap)
    return (events.where(F.col(time).isNotNull()).groupBy(key, window.alias("s"))
            .agg(F.count(F.lit(1)).alias("n_events"), F.sum(value).alias("total_value"))
            .select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n_events", "total_value"))


def stream_sessions(events: DataFrame, key: str, time: str, gap: str, value: str, delay: str) -> DataFrame:
    """The streaming form: a session is emitted once the watermark (``delay`` behind the latest time) passes its end."""
    return sessions(events.withWatermark(time, delay), key, time, gap, value)
