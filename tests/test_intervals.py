import datetime
import random
import tempfile

import oracle_check
from pyspark.sql import functions as F

from panelwright.operators.intervals import interval_join, sessions, stream_sessions
from panelwright.plans.catalogue import load

SF = "/root/testdata/sf0.001"
BASE = datetime.datetime(2024, 1, 1)


def at(seconds):
    return None if seconds is None else BASE + datetime.timedelta(seconds=seconds)


def test_equals_brute_force_with_a_very_long_interval(spark):
    rng = random.Random(4)
    points = [(i, at(rng.randint(0, 100_000))) for i in range(300)] + [(999, None)]
    spans = [(j, at(s), at(s + rng.randint(0, 5_000))) for j, s in ((j, rng.randint(0, 100_000)) for j in range(200))]
    spans += [(500, at(0), at(100_000)), (501, at(50), at(10)), (502, None, at(5)), (503, at(7), at(7))]
    got = interval_join(spark.createDataFrame(points, "pid long, t timestamp"), spark.createDataFrame(spans, "sid long, s timestamp, e timestamp"),
                        "t", "s", "e", 600)
    pairs = sorted((r.pid, r.sid) for r in got.collect())
    want = sorted((p, j) for p, t in points for j, s, e in spans if t is not None and s is not None and e is not None and s <= t <= e)
    assert pairs == want and any(j == 500 for _, j in pairs)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_keys_and_a_crowded_bucket(spark):
    points = [(i % 3, i, at(10 + i % 5)) for i in range(3000)]
    spans = [(k, j, at(j), at(j + 12)) for k in range(3) for j in range(20)]
    got = interval_join(spark.createDataFrame(points, "k int, pid long, t timestamp"), spark.createDataFrame(spans, "k int, sid long, s timestamp, e timestamp"),
                        "t", "s", "e", 1, keys=["k"])
    want = sum(1 for k, _, t in points for k2, _, s, e in spans if k == k2 and s <= t <= e)
    assert got.count() == want


def test_interval_join_plan_equals_oracle(spark):
    query, sql = load()[0]["g12_interval_join"], load()[1]["g12_interval_join"]
    assert oracle_check.compare(query(spark, SF), oracle_check.duck(SF), sql) is None


def test_streamed_sessions_equal_the_batch_on_closed_sessions(spark):
    rng = random.Random(5)
    rows = [(rng.randint(1, 4), at(rng.randint(0, 20_000)), float(rng.randint(0, 9))) for _ in range(500)]
    rows.sort(key=lambda r: r[1])
    folder = tempfile.mkdtemp(prefix="sessions-")
    df = spark.createDataFrame(rows, "user_id int, ts timestamp, value double")
    for k in range(4):  # files in time order, each one micro-batch
        df.where(f"ts >= timestamp'{at(5000 * k)}' and ts < timestamp'{at(5000 * (k + 1))}'").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = stream_sessions(stream, "user_id", "ts", "10 minutes", "value", "0 seconds").writeStream.format("parquet").outputMode("append") \
        .option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    streamed = {tuple(r) for r in spark.read.parquet(f"{folder}/out").collect()}
    batch = {tuple(r) for r in sessions(df, "user_id", "ts", "10 minutes", "value").collect()}
    closed = {r for r in batch if r[2] <= max(x[1] for x in rows)}
    assert streamed and closed <= batch and streamed == {r for r in streamed if r in batch} and len(streamed) >= len(closed) - 4


def test_totals_equal_the_sums_over_pairs(spark):
    """Sums around each distinct point, with keys (null ones match nothing), repeated points and spans that end on a bucket's edge."""
    rng = random.Random(6)
    points = [(rng.choice([1, 2, None]), i, at(rng.randint(-2_000, 40_000) // 7 * 7)) for i in range(400)] + [(1, 999, None)]
    spans = [(rng.choice([1, 2, None]), j, at(s), at(s + rng.choice([0, 59, 60, 599, 600, 5_000, 39_000])), rng.choice([None, j])) for j, s in ((j, rng.randint(-2_000, 40_000)) for j in range(300))]
    spans += [(1, 500, at(50), at(10), 1), (2, 501, None, at(5), 1)]
    p = spark.createDataFrame(points, "k int, pid long, t timestamp")
    i = spark.createDataFrame(spans, "k int, sid long, s timestamp, e timestamp, v long")
    got = interval_join(p, i, "t", "s", "e", 60, keys=["k"], totals={"n": F.lit(1), "v": F.col("v")})
    seen = {(r.k, r.t): (r.n, r.v) for r in got.collect()}
    pairs = {}
    for k, t in {(k, t) for k, _, t in points if k is not None and t is not None}:
        inside = [x for k2, _, s, e, x in spans if k == k2 and s is not None and s <= t <= e]
        pairs[(k, t)] = (len(inside), sum(x or 0 for x in inside))
    assert seen == pairs and max(n for n, _ in seen.values()) > 1


def test_open_orders_do_not_grow_with_pairs(spark):
    """30,000 orders of distinct times, all open at once (900 million pairs), one key twice, one price missing, one infinite."""
    folder, n = tempfile.mkdtemp(prefix="open-"), 30_000
    price = "case when id = 7 then null when id = 11 then double('inf') else id % 100 + 0.25 end"
    orders = spark.range(n).selectExpr("if(id = 5, 4, id) o_orderkey", "timestamp_seconds(1700000000 + id) o_orderdate", f"cast({price} as double) o_totalprice")
    orders.write.parquet(f"{folder}/orders.parquet")
    spark.range(n).selectExpr("id l_orderkey", "timestamp_seconds(1700000000 + 100000 + id) l_shipdate").write.parquet(f"{folder}/lineitem.parquet")
    got = {}
    for r in load()[0]["g12_interval_join"](spark, folder).collect():
        got.setdefault(r.o_orderkey, set()).add((r.n_open, r.open_value))
    value = [0.0 if k == 7 else k % 100 + 0.25 for k in range(n)]
    sums = [0.0]
    for v in value:
        sums.append(sums[-1] + v)
    inf = float("inf")
    assert got[0] == {(0, 0.0)} and got[3] == {(3, sums[3])} and got[4] == {(4 + 4, sums[4] + sums[4])} and got[10] == {(10, sums[10])}
    assert got[11] == {(11, sums[11])} and got[12] == {(12, inf)} and got[n - 1] == {(n - 1, inf)} and len(got) == n - 1
