"""Online lag features with keyed state and event-time timers (``transformWithStateInPandas``).

Per key the state holds

* ``emitted``: the (time, order) of the last emitted row and the last ``lags``
  emitted values,
* ``waiting``: a map from (first millisecond, number) to a block of at most
  ``BLOCK`` rows in time order that wait for the watermark,
* ``pending``: the number of the next block and the time of the key's timer,

and one timer, at the first waiting row. A micro-batch writes its rows of a key
as new blocks. When the watermark passes the timer, only the blocks that begin
before the watermark are read, merged in time order and emitted; the rest of a
block that the watermark cuts is written back. No batch reads or rewrites the
whole state of a key, calls to the store go by block and not by row, and a
merge holds only the blocks that overlap in time.

A row whose (time, order) is not after the last emitted row of its key is late:
its lags can no longer be right, so it comes out once with ``late`` set and no
lags, and the state is left as it was. Rows with no time have no place and
are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from panelwright.sources.scratch import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
FAR_FUTURE = "2261-01-01 00:00:00"  # the latest year that pandas holds in nanoseconds
BLOCK = 512  # rows of a waiting block: bounds what is written back when the watermark cuts it
EMIT = 8192  # rows gathered before a frame is emitted
MICROS = "event_micros"  # the time column as the processor sees it (names with a leading underscore do not reach it)


class LagProcessor(StatefulProcessor):
    """Emits each row with the ``lags`` values before it in (time, order), once the watermark has passed it."""

    def __init__(self, key: str, order: str, value: str, lags: int, order_type: str):
        self.key, self.order, self.value, self.lags, self.order_type = key, order, value, lags, order_type
        self.names = [f"{value}_lag_{k}" for k in range(1, lags + 1)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.emitted = handle.getValueState("emitted", f"micros long, id {self.order_type}, past array<double>")
        self.pending = handle.getValueState("pending", "number long, timer long")
        self.waiting = handle.getMapState("waiting", "ms long, number long",
                                          f"micros array<long>, ids array<{self.order_type}>, vals array<double>")

    def _frame(self, key, ids, values, lags, late: bool) -> pd.DataFrame:
        out = pd.DataFrame({self.key: [key] * len(ids), self.order: ids, self.value: np.asarray(values, dtype=float)})
        for k, name in enumerate(self.names):
            out[name] = lags[:, k] if len(ids) else np.zeros(0)
        out["late"] = late
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        emitted = self.emitted.get()
        late_ids, late_values, fresh = [], [], []
        for batch in rows:
            micros, ids, values = batch[MICROS].tolist(), batch[self.order].tolist(), batch[self.value].astype(float).tolist()
            for m, i, v in zip(micros, ids, values):
                if emitted is not None and (m, i) <= (emitted[0], emitted[1]):
                    late_ids.append(i)
                    late_values.append(v)
                else:
                    fresh.append((m, i, v))
        if fresh:
            number, timer = self.pending.get() or (0, None)
            fresh.sort(key=lambda r: r[0])
            number = self._wait(fresh, number)
            self._set_timer(number, timer, fresh[0][0] // 1000 + 1)
        if late_ids:
            yield self._frame(key[0], late_ids, late_values, np.full((len(late_ids), self.lags), np.nan), True)

    def _wait(self, rows: list, number: int) -> int:
        """Writes rows in time order as new blocks; returns the next block's number."""
        for lo in range(0, len(rows), BLOCK):
            micros, ids, values = zip(*rows[lo:lo + BLOCK])
            self.waiting.updateValue((micros[0] // 1000, number), (list(micros), list(ids), list(values)))
            number += 1
        return number

    def _set_timer(self, number: int, timer: int | None, wanted: int) -> None:
        """Leaves the key one timer: the earlier of the set and the wanted one."""
        if timer is None or wanted < timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(wanted)
            timer = wanted
        self.pending.update((number, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        blocks = sorted(tuple(k) for k in self.waiting.keys())
        ready = [b for b in blocks if b[0] < passed]
        number = self.pending.get()[0]
        held, done, rest = [], [], []
        for at, block in enumerate(ready):
            rows = list(zip(*self.waiting.getValue(block)))
            held += [r for r in rows if r[0] // 1000 < passed]
            rest += [r for r in rows if r[0] // 1000 >= passed]
            self.waiting.removeKey(block)
            # no later block holds a row before its first millisecond
            limit = ready[at + 1][0] if at + 1 < len(ready) else passed
            held.sort(key=lambda r: (r[0], r[1]))
            cut = next((k for k, r in enumerate(held) if r[0] // 1000 >= limit), len(held))
            done, held = done + held[:cut], held[cut:]
            if len(done) >= EMIT:
                yield self._emit(key[0], done)
                done = []
        if done:
            yield self._emit(key[0], done)
        first = [b[0] for b in blocks[len(ready):]]
        if rest:
            rest.sort(key=lambda r: r[0])
            number = self._wait(rest, number)
            first.append(rest[0][0] // 1000)
        if first:
            self._set_timer(number, None, min(first) + 1)
        else:
            self.pending.update((number, None))

    def _emit(self, key, rows: list) -> pd.DataFrame:
        emitted = self.emitted.get()
        past = list(emitted[2]) if emitted is not None else []
        seq = np.array([np.nan] * (self.lags - len(past)) + past + [r[2] for r in rows], dtype=float)
        lags = np.stack([seq[self.lags - k:len(seq) - k] for k in range(1, self.lags + 1)], axis=1)
        self.emitted.update((rows[-1][0], rows[-1][1], seq[len(seq) - self.lags:].tolist()))
        return self._frame(key, [r[1] for r in rows], [r[2] for r in rows], lags, False)

    def close(self) -> None:
        pass


def timer_lags(events: DataFrame, key: str, time: str, order: str, value: str, lags: int, delay: str) -> DataFrame:
    """The streaming frame: key, order, value, value_lag_1..lags, late."""
    fields = {f.name: f.dataType for f in events.schema.fields}
    schema = T.StructType([T.StructField(key, fields[key]), T.StructField(order, fields[order]), T.StructField(value, T.DoubleType())]
                          + [T.StructField(f"{value}_lag_{k}", T.DoubleType()) for k in range(1, lags + 1)]
                          + [T.StructField("late", T.BooleanType())])
    processor = LagProcessor(key, order, value, lags, fields[order].simpleString())
    timed = events.where(F.col(time).isNotNull()).select(key, order, time, F.col(value).cast("double").alias(value),
                                                         F.unix_micros(time).alias(MICROS))
    return timed.withWatermark(time, delay).groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime")


def run_timer_lags(events: DataFrame, key: str, time: str, order: str, value: str, lags: int, delay: str) -> tuple[DataFrame, int]:
    """Lag features of all rows a stream has available as a written table, and the number of rows Spark dropped as too late.

    Rows behind their key's last emitted row but not behind the watermark come
    out with ``late`` set; rows behind the watermark never reach the state and
    are counted instead.

    A second run on the same checkpoint adds one row far in the future, whose
    watermark fires every key's timer. The state store is RocksDB, which the
    timers need; the session's setting is restored afterwards.
    """
    spark = events.sparkSession
    ends, out, checkpoint = (scratch_path(spark, f"timer-lags-{x}") for x in ("end", "out", "checkpoint"))
    columns = events.select(key, order, time, value)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in columns.schema.fields])
    spark.createDataFrame([], schema).write.parquet(ends)
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    dropped = 0
    try:
        for last in (False, True):
            if last:
                end = {time: F.lit(FAR_FUTURE)}
                spark.range(1).select(*[end.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]).write.mode("append").parquet(ends)
            both = columns.unionByName(spark.readStream.schema(schema).parquet(ends))
            lagged = timer_lags(both, key, time, order, value, lags, delay)
            query = lagged.writeStream.outputMode("append").format("parquet").option("path", out).option(
                "checkpointLocation", checkpoint).trigger(availableNow=True).start()
            query.awaitTermination()
            dropped += sum(s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for s in p["stateOperators"])
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
    return spark.read.schema(lagged.schema).parquet(out).where(F.col(key).isNotNull() | F.col(order).isNotNull()), dropped
