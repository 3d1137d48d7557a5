import datetime
import math
import random
import tempfile

import oracle_check
import pandas as pd

from panelwright.plans.catalogue import load
from panelwright.streaming import timers

SF = "/root/testdata/sf0.001"


def brute(rows, lags=3):
    want = {}
    for u in {r[0] for r in rows}:
        seq = sorted((r for r in rows if r[0] == u and r[2] is not None), key=lambda r: (r[2], r[1]))
        for k, r in enumerate(seq):
            want[(u, r[1])] = (r[3], *[seq[k - j][3] if k - j >= 0 else None for j in range(1, lags + 1)])
    return want


def run(spark, rows, files, delay):
    folder = tempfile.mkdtemp(prefix="timers-")
    batch = spark.createDataFrame(rows, "user_id int, event_id long, ts timestamp, value double")
    batch.repartition(files).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    table, dropped = timers.run_timer_lags(stream, "user_id", "ts", "event_id", "value", 3, delay)
    nan = lambda x: None if x is None or (isinstance(x, float) and math.isnan(x)) else x
    return {(r[0], r[1]): tuple(nan(x) for x in r[2:6]) for r in table.collect()}, table, dropped


def test_shuffled_files_equal_the_batch_answer(spark):
    rng = random.Random(1)
    base = datetime.datetime(2024, 1, 1)
    rows = [(rng.randint(1, 5), i, base + datetime.timedelta(seconds=rng.randint(0, 3600)), float(rng.randint(0, 100))) for i in range(400)]
    rows += [(2, 1000, None, 5.0)]  # no time: left out
    got, table, dropped = run(spark, rows, 4, "7200 seconds")
    assert got == brute(rows) and dropped == 0 and table.where("late").count() == 0


def test_one_key_with_many_waiting_rows_and_equal_times(spark):
    base = datetime.datetime(2024, 1, 1)
    rows = [(7, i, base + datetime.timedelta(milliseconds=i // 3), float(i % 13)) for i in range(3000)]
    random.Random(2).shuffle(rows)
    got, _, dropped = run(spark, rows, 3, "1 hour")
    assert got == brute(rows) and dropped == 0


def test_rows_behind_their_key_are_listed_or_counted(spark):
    base = datetime.datetime(2024, 1, 1)
    early = [(1, i, base + datetime.timedelta(hours=i), 1.0) for i in range(10)]
    folder = tempfile.mkdtemp(prefix="timers-")
    spark.createDataFrame(early, "user_id int, event_id long, ts timestamp, value double").coalesce(1).write.parquet(f"{folder}/in")
    for extra in [(1, 50, base + datetime.timedelta(hours=20), 3.0), (1, 99, base, 2.0)]:
        spark.createDataFrame([extra], "user_id int, event_id long, ts timestamp, value double").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema("user_id int, event_id long, ts timestamp, value double").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    table, dropped = timers.run_timer_lags(stream, "user_id", "ts", "event_id", "value", 3, "1 second")
    on_time = {r.event_id for r in table.where("not late").collect()}
    assert on_time == set(range(10)) | {50}
    assert dropped + table.where("late").count() == 1


class Calls:
    """State and timers of one key that count the calls to them."""

    def __init__(self):
        self.calls, self.stores, self.timers = 0, {}, set()

    def store(self, name, *_):
        return self.stores.setdefault(name, Store(self))

    getValueState = getMapState = getListState = store

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.calls += 1
        self.timers.remove(ms)


class Store:
    def __init__(self, owner):
        self.owner, self.value, self.map, self.largest = owner, None, {}, 0

    def __getattribute__(self, name):
        if name in ("get", "update", "getValue", "updateValue", "removeKey", "keys", "exists", "put"):
            self.owner.calls += 1
        return object.__getattribute__(self, name)

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    put = update

    def keys(self):
        return list(self.map)

    def getValue(self, key):
        return self.map.get(key)

    def updateValue(self, key, value):
        self.map[key] = value

    def removeKey(self, key):
        self.map.pop(key)


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


def test_state_calls_grow_with_blocks_and_not_with_rows(monkeypatch):
    """Overlapping batches of one key under a creeping watermark: right lags, few calls, one timer."""
    monkeypatch.setattr(timers, "EMIT", 700)
    handle, rng, rows, out = Calls(), random.Random(3), [], []
    processor = timers.LagProcessor("user_id", "event_id", "value", 3, "bigint")
    processor.init(handle)

    def fire(ms):
        for expiry in sorted(t for t in handle.timers if t <= ms):
            handle.timers.discard(expiry)
            out.extend(processor.handleExpiredTimer((1,), Clock(ms), Clock(expiry)))

    for step in range(6):
        new = [(1, 1000 * step + i, 20_000 * step + rng.randint(0, 40_000), float(rng.randint(0, 99))) for i in range(1000)]
        rows += new
        frame = pd.DataFrame(new, columns=["user_id", "event_id", "ms", "value"])
        frame[timers.MICROS] = frame.pop("ms") * 1000
        assert not list(processor.handleInputRows((1,), iter([frame[:600], frame[600:]]), None))
        fire(20_000 * step)
        assert len(handle.timers) == 1
    fire(10**9)
    got = pd.concat(out)
    nan = lambda x: None if math.isnan(x) else x
    assert {(1, r[1]): tuple(nan(x) for x in r[2:6]) for r in got.itertuples(index=False)} == brute(rows)
    assert not got["late"].any() and not handle.timers and not handle.stores["waiting"].map and handle.calls < len(rows) / 10


def test_equals_oracle(spark):
    query, sql = load()[0]["o4_timer_lags"], load()[1]["o4_timer_lags"]
    assert oracle_check.compare(query(spark, SF), oracle_check.duck(SF), sql) is None
