"""Structured Streaming monitors: windowed drift, alerts, quality on late labels and online lags.

Results are appended to Parquet in shared storage by Spark's own file sink, which
commits each micro-batch once; readers see closed windows only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from panelwright.operators.drift import bin_index, jensen_shannon, level_shares
from panelwright.operators.profile import column_range
from panelwright.operators.scale import numbered_by_hash, running_totals
from panelwright.sources.scratch import materialize, scratch_path

# Later than any event; within the range of nanosecond clocks, in which Python workers read times.
FAR_FUTURE = "2200-01-01"


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None,
                max_bytes: int | None = None) -> DataFrame:
    """Parquet file stream with an explicit schema; the limits bound one micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def run_available(stream: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Process what is available, append it to Parquet and return the written table."""
    spark = stream.sparkSession
    out = scratch_path(spark, label)
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", out).option(
        "checkpointLocation", scratch_path(spark, f"{label}-checkpoint")).trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def event_time(c: Column | str) -> Column:
    """Event time for watermarks: a zone-less timestamp read as UTC, under any session zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(c) if isinstance(c, str) else c).cast("timestamp")


def utc_text(c: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    """An instant as UTC text."""
    wall = (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")
    return F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), wall), pattern)


class DriftBaseline:
    """Frozen shares of a categorical column, as a table, and of a binned numeric column."""

    def __init__(self, category: str, number: str, bins: int = 20):
        self.category, self.number, self.bins = category, number, bins

    def fit(self, df: DataFrame) -> "DriftBaseline":
        shares = materialize(level_shares(df, self.category).where(F.col(self.category).isNotNull()).select(
            F.col(self.category).cast("string").alias("key"), F.col("share").alias("base")), "baseline")
        # rank 1 is the largest share; ties in hash order
        below = running_totals(shares.groupBy("base").agg(F.count(F.lit(1)).alias("n")), "base", ["n"]).select("base", (F.col("tot_n") - F.col("cum_n")).alias("_above"))
        self.levels = materialize(numbered_by_hash(shares, ["key"], ["base"], out="_no").join(below, "base").select(
            "key", "base", (F.col("_above") + F.col("_no")).alias("rank")), "baseline-ranked")
        self.low, self.high = column_range(df, self.number)
        binned = df.where(F.col(self.number).isNotNull()).select(bin_index(F.col(self.number), self.low, self.high, self.bins).alias("_bin"))
        found = {r["_bin"]: float(r["share"]) for r in level_shares(binned, "_bin").collect()}
        self.bin_shares = [found.get(i, 0.0) for i in range(self.bins)]
        return self

    def counts(self, events: DataFrame, time: str, window: str, delay: str) -> DataFrame:
        """Rows per (window, kind, key): the levels and bins of each tumbling window.

        As a stream in append mode it emits a window once the watermark has passed
        it, so the last open window of a bounded source is not among them.
        """
        number = bin_index(F.col(self.number), self.low, self.high, self.bins)
        sides = F.explode(F.array(
            F.struct(F.lit("level").alias("kind"), F.col(self.category).cast("string").alias("key")),
            F.struct(F.lit("bin").alias("kind"), number.cast("string").alias("key")))).alias("s")
        counts = events.withWatermark(time, delay).select(time, sides).where(F.col("s.key").isNotNull()).groupBy(
            F.window(time, window).alias("window"), "s.kind", "s.key").agg(F.count(F.lit(1)).alias("n"))
        return counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "kind", "key", "n")

    def distances(self, counts: DataFrame) -> DataFrame:
        """Distances from the baseline per window of a table of ``counts``.

        Levels are joined, so neither side's number of levels is bounded. The
        largest share of an absent level is that of the first rank without a row.
        """
        slot = ["window_start", "window_end"]
        level = counts.where("kind = 'level'").join(self.levels, "key", "left")
        totals = level.groupBy(*slot).agg(F.sum("n").alias("total"))
        gap = F.abs(F.col("n") / F.col("total") - F.coalesce("base", F.lit(0.0)))
        seen = level.join(totals, slot).groupBy(*slot).agg(F.max("total").alias("n"), F.max(gap).alias("_seen"))
        ranks = level.where("rank is not null").select(*slot, "rank")
        # rank 0 stands before every window's first rank
        starts = ranks.unionByName(totals.select(*slot, F.lit(0).cast("long").alias("rank")))
        following = ranks.select(*slot, (F.col("rank") - 1).alias("rank"))
        missing = starts.join(following, [*slot, "rank"], "left_anti").groupBy(*slot).agg((F.min("rank") + 1).alias("rank"))
        absent = missing.join(self.levels.select("rank", F.col("base").alias("_absent")), "rank", "left").select(*slot, "_absent")
        bins = counts.where("kind = 'bin'").groupBy(*slot).agg(F.sum("n").alias("_t"), F.map_from_entries(F.collect_list(F.struct("key", "n"))).alias("_bins"))
        terms = [jensen_shannon(F.lit(p), F.coalesce(F.try_element_at("_bins", F.lit(str(i))), F.lit(0)) / F.col("_t")) for i, p in enumerate(self.bin_shares)]
        divergence = terms[0]
        for t in terms[1:]:
            divergence = divergence + t
        return seen.join(absent, slot).join(bins.select(*slot, divergence.alias("js_divergence")), slot, "left").select(
            *slot, "n", F.greatest("_seen", F.coalesce("_absent", F.lit(0.0))).alias("l_infinity"), "js_divergence")


def alerts(windows: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Windows with a distance above its limit, one row per breached metric."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"), F.lit(v).alias("limit")) for m, v in limits.items()])).alias("a")
    return windows.select("window_start", "window_end", rows).where(F.col("a.value") > F.col("a.limit")).select(
        "window_start", "window_end", "a.metric", "a.value", "a.limit")


def labelled_quality(predictions: DataFrame, labels: DataFrame, key: str, predicted_at: str, labelled_at: str,
                     wait: str, delay: str) -> DataFrame:
    """Join a stream of predictions with a stream of labels that arrive within ``wait``.

    Watermarks on both sides and the time bound let Spark drop old join state.
    Returns one row per labelled prediction with its correctness.
    """
    p = predictions.withWatermark(predicted_at, delay).alias("p")
    y = labels.withWatermark(labelled_at, delay).withColumnRenamed(key, "_key").alias("y")
    bound = (F.col(labelled_at) >= F.col(predicted_at)) & (F.col(labelled_at) <= F.col(predicted_at) + F.expr(f"INTERVAL {wait}"))
    joined = p.join(y, (F.col(key) == F.col("_key")) & bound, "inner")
    return joined.select(key, predicted_at, labelled_at, (F.col("label") == F.col("prediction")).cast("int").alias("correct"))


def quality_windows(rows: DataFrame, time: str, window: str) -> DataFrame:
    """Accuracy per tumbling window of the joined rows."""
    return rows.groupBy(F.window(time, window).alias("w")).agg(
        F.avg("correct").alias("accuracy"), F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), "accuracy", "n")


def source_lateness(table: DataFrame, time: str) -> int:
    """Seconds by which the latest rows of a file come behind rows of files read before it; 0 for files in time order.

    A file stream reads files by modification time. One row a file is ordered, not the rows.
    """
    files = table.select(F.col("_metadata.file_modification_time").alias("m"), F.col("_metadata.file_path").alias("p"), F.unix_micros(time).alias("t"))
    files = files.groupBy("m", "p").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    # files of the same second can come in any order, so each is compared with all of them
    before = Window.orderBy("m").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    late = files.select((F.max("hi").over(before) - F.col("lo")).alias("late"), F.count(F.lit(1)).over(Window.partitionBy()).alias("n"))
    found = late.where("n > 1").agg(F.max("late")).first()[0]
    return max(0, -(-(found or 0) // 1_000_000))


def online_lags(events: DataFrame, key: str, time: str, order: str, value: str, lags: int, delay: str) -> DataFrame:
    """Lag features of every new value from the ``lags`` values before it, per key in (time, order).

    A row waits in the key's state until the watermark has passed it, so rows of
    later micro-batches take their place before it; NULL values keep theirs.
    State holds the last ``lags`` values and the rows of one ``delay``. A row that
    comes after later ones were emitted is passed on with ``late`` set and without
    lags; Spark itself drops and counts rows that come later still. See
    ``run_online_lags``, which raises for both and emits the last rows of a bounded
    source.
    """
    fields = {f.name: f.dataType.simpleString() for f in events.schema.fields}
    names = [f"{value}_lag_{k}" for k in range(1, lags + 1)]
    schema = f"{key} {fields[key]}, {order} {fields[order]}, {value} double, " + ", ".join(f"{n} double" for n in names) + ", late boolean"
    kept = f"upto bigint, past array<double>, micros array<bigint>, ids array<{fields[order]}>, vals array<double>"

    def update(group: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        upto, past, micros, ids, values = state.get if state.exists else (-1 << 62, [], [], [], [])
        past, micros, ids, values = list(past), list(micros), list(ids), list(values)
        for b in batches:
            behind = (b["_micros"] <= upto).to_numpy()
            if behind.any():
                lost = b[behind]
                yield pd.DataFrame({key: group[0], order: lost[order].to_numpy(), value: lost[value].astype(float).to_numpy(), **dict.fromkeys(names, np.nan), "late": True})
            b = b[~behind]
            micros += b["_micros"].tolist()
            ids += b[order].tolist()
            values += b[value].astype(float).tolist()
        # plain lists: a key has few rows, and frames for each of them would take most of the time
        blank = [x is None or x != x for x in ids]
        place = sorted(range(len(micros)), key=lambda i: (micros[i], blank[i], 0 if blank[i] else ids[i]))
        watermark = state.getCurrentWatermarkMs() * 1000
        cut = sum(m <= watermark for m in micros)
        ready, waiting = place[:cut], place[cut:]
        taken = [values[i] for i in ready]
        seq = np.array([np.nan] * (lags - len(past)) + past + taken, dtype=float)
        if ready:
            upto = micros[ready[-1]]
        state.update((upto, (past + taken)[-lags:], [micros[i] for i in waiting], [ids[i] for i in waiting], [values[i] for i in waiting]))
        if waiting:
            state.setTimeoutTimestamp(micros[waiting[0]] // 1000 + 1)
        if ready:
            yield pd.DataFrame({key: group[0], order: [ids[i] for i in ready], value: seq[lags:],
                                **{n: seq[lags - k:len(seq) - k] for k, n in enumerate(names, 1)}, "late": False})

    timed = events.where(F.col(time).isNotNull()).withColumn("_micros", F.unix_micros(time))
    return timed.withWatermark(time, delay).groupBy(key).applyInPandasWithState(update, schema, kept, "append", "EventTimeTimeout")


def run_online_lags(events: DataFrame, key: str, time: str, order: str, value: str, lags: int, delay: str) -> DataFrame:
    """Lag features of all rows that a stream has available, as a written table.

    A second run on the same checkpoint adds one row far in the future, which
    moves the watermark past all waiting rows. Raises when rows came later than
    ``delay`` allows, as their lags would be missing. Rows without a time have no
    place and are left out.
    """
    spark = events.sparkSession
    ends, out, checkpoint = (scratch_path(spark, f"lags-{x}") for x in ("end", "out", "checkpoint"))
    columns = events.select(key, order, time, value)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in columns.schema.fields])
    spark.createDataFrame([], schema).write.parquet(ends)
    late = 0
    for last in (False, True):
        if last:
            # it waits for a watermark that never comes and so emits nothing itself
            end = {time: F.lit(FAR_FUTURE)}
            spark.range(1).select(*[end.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]).write.mode("append").parquet(ends)
        both = columns.unionByName(spark.readStream.schema(schema).parquet(ends))
        lagged = online_lags(both, key, time, order, value, lags, delay)
        query = lagged.writeStream.outputMode("append").format("parquet").option("path", out).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        late += sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    table = spark.read.schema(lagged.schema).parquet(out)
    late += table.where("late").count()
    if late:
        raise ValueError(f"{late} rows came more than {delay} late; allow a longer delay")
    return table.drop("late")
