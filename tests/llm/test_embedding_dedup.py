import numpy as np
from conftest import SF

from panelwright.llm import embedding_dedup
from panelwright.llm.hnsw import Graph


def data(n=900, dims=16, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 3, dims))
    rows = [*base, *(base[: n // 6] + rng.normal(size=(n // 6, dims)) * 0.12), *(base[0] + rng.normal(size=(n // 4, dims)) * 0.08), *(base[:20] * 3.5), *base[:15]]
    return [(i, [float(x) for x in v], i % 2 if i < n // 3 else 0) for i, v in enumerate(rows)]


def brute(rows, least=0.98):
    links = {i: 0 for i, _, _ in rows}
    part = {i: i for i, _, _ in rows}
    good = [(i, np.array(v), lab) for i, v, lab in rows if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    near = []
    for a in range(len(good)):
        for b in range(a):
            (i, x, k), (j, y, m) = good[a], good[b]
            if k == m and len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= least:
                links[i] += 1
                links[j] += 1
                near.append((i, j))
    changed = True
    while changed:
        changed = False
        for i, j in near:
            low = min(part[i], part[j])
            changed |= part[i] != low or part[j] != low
            part[i] = part[j] = low
    return {i: (links[i], part[i], part[i] == i) for i in links}


def compare(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = embedding_dedup.near_duplicates(df, **kw).collect()
    assert len(got) == len(rows)
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got}, brute(rows)


def test_one_shard_equals_brute_force(spark):
    got, want = compare(spark, data())
    assert got == want


def test_many_shards_equal_brute_force(spark):
    got, want = compare(spark, data(seed=1), capacity=100)
    assert got == want


def test_vectors_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, v, 0), (3, None, 0), (4, [0.0, 0.0, 0.0], 0), (5, [0.0, 0.0, 0.0], 0), (6, [1.0, None, 3.0], 0), (7, [nan, 2.0, 3.0], 0), (8, [inf, 2.0, 3.0], 0),
            (9, v, None), (10, v, None), (11, v, 1), (12, [-0.0, 1.0, 0.0], 1), (13, [0.0, 1.0, 0.0], 1), (14, [1.0, 2.0], 0), (15, [], 0), (16, [2.0, 4.0, 6.0], 0)]
    got, want = compare(spark, rows)
    assert got == want


def test_repeated_rows_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 0, "x")] * 3 + [(None, [1.0, 0.0], 0, "x"), (2, [0.0, 1.0], 0, "x")], "vec_id long, embedding array<float>, label int, g string")
    got = sorted((tuple(r) for r in embedding_dedup.near_duplicates(df).collect()), key=str)
    assert got == [(1, 3, 1, True)] * 3 + [(2, 0, 2, True), (None, 3, 1, False)]
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_graph_recall_and_round_trip():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(150, 32))
    vectors = np.concatenate([centres[rng.integers(0, 150, 2500)] + rng.normal(size=(2500, 32)) * 0.1, rng.normal(size=(1500, 32))])
    graph = Graph(vectors)
    assert graph.beam < len(vectors)
    again = Graph.from_bytes(graph.to_bytes())
    exact, found = graph.exact(vectors[:600], 0.98), again.within(vectors[:600], 0.98)
    assert all(np.isin(f, e).all() for f, e in zip(found, exact))
    assert sum(map(len, found)) >= 0.98 * sum(map(len, exact))


def clustered(n=2000, dims=24):
    """A third of near copies, the rest in pairs."""
    rng = np.random.default_rng(8)
    pairs = rng.normal(size=(n // 3, dims))
    return np.concatenate([rng.normal(size=dims) + rng.normal(size=(n // 3, dims)) * 0.02, pairs, pairs + rng.normal(size=pairs.shape) * 0.05])


def test_audit_sees_lost_pairs_beside_a_hot_cluster():
    class Lossy(Graph):
        def within(self, raw, least, beam=None):
            got = self.exact(raw, least)
            return got if self.beam >= 128 else [x if len(x) > 2 else x[:0] for x in got]

    assert Lossy(clustered()).beam >= 128


def test_audit_sees_queries_that_are_no_nodes():
    class Lossy(Graph):
        def within(self, raw, least, beam=None):
            known = set(map(bytes, self.raw))
            return [x if self.beam >= 128 or bytes(r) in known else x[:0] for r, x in zip(raw, self.exact(raw, least))]

    assert Lossy(clustered()).beam >= 128
    assert Lossy(clustered(), others=clustered()[:9] * 2).beam >= 128


def test_audit_grows_with_the_graph_and_takes_given_vectors():
    asked = []

    class Counting(Graph):
        def within(self, raw, least, beam=None):
            asked.append(len(raw))
            return self.exact(raw, least)

    Counting(clustered(3000), others=clustered()[:77])
    assert asked[:3] == [187, 187, 77]


def test_shards_get_vectors_of_other_shards_for_the_audit(spark):
    placed = spark.range(6000).selectExpr("id g", "cast(id % 3 as int) shard", "3 shards")
    got = embedding_dedup._with_queries(placed).where("outside").toPandas()
    assert (got["g"] % 3 != got["shard"]).all() and got["shard"].value_counts().between(60, 200).all() and got["shard"].nunique() == 3


def test_registered_query(spark):
    import __spark_entry__

    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in __spark_entry__.queries()["op4_embedding_dedup"](spark, SF).collect()}
    assert got == brute(rows)
