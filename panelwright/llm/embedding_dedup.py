"""Near-duplicate vectors by small-world graphs for each shard.

Equal vectors of a label count as one, with their number. The distinct vectors
of a label are dealt to shards of bounded size; each shard gets a graph, and
each block of vectors of the label queries every shard. Matches are verified in
double precision; what leaves a task is a count for each query and a spanning
link for each member of a local component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelwright.llm.components import connected_components
from panelwright.llm.hnsw import AUDITED, Graph
from panelwright.sources.scratch import materialize

LEAST = 0.98
CAPACITY = 16384  # distinct vectors of a shard or of a block of queries, about


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def _identified(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v, g): g names equal vectors of a label; null for rows that link with nothing."""
    v = F.col("embedding").cast("array<double>")
    norm = F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)
    # a null or non-finite component, or one whose square overflows, makes the sum null, NaN or infinite
    usable = F.col("label").isNotNull() & v.isNotNull() & norm.isNotNull() & ~F.isnan(norm) & (norm > 0) & (norm < float("inf"))
    v = F.transform(v, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))  # one zero
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), v.alias("v"), F.coalesce(usable, F.lit(False)).alias("ok")).select(
        "vec_id", "label", F.when(F.col("ok"), F.col("v")).alias("v"), F.when(F.col("ok"), F.xxhash64("label", "v")).alias("g"))


def _with_queries(placed: DataFrame) -> DataFrame:
    """``placed`` and, marked ``outside``, a sample of the other shards' vectors for each shard: about one for ``AUDITED`` of its own."""
    other = F.explode(F.filter(F.sequence(F.lit(0), F.col("shards") - 1), lambda k: (k != F.col("shard")) & (F.pmod(F.xxhash64(F.lit(19), "g", k), AUDITED * (F.col("shards") - 1)) == 0)))
    sample = placed.where("shards > 1").withColumn("shard", other)
    return placed.withColumn("outside", F.lit(False)).unionByName(sample.withColumn("outside", F.lit(True)))


def _links(groups: DataFrame, least: float, capacity: int) -> DataFrame:
    """(a, b, n): for each vector group the number of other vectors it links with in one shard, or a spanning link a-b (n null)."""
    sizes = materialize(groups.groupBy("label", F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("in_label")), "label-sizes")
    shards = F.greatest(F.lit(1), F.ceil(F.col("in_label") / capacity)).cast("int")
    placed = groups.withColumn("width", F.size("v")).join(sizes, ["label", "width"]).withColumn("shards", shards)
    placed = materialize(placed.withColumn("shard", F.pmod(F.xxhash64(F.lit(17), "g"), F.col("shards")).cast("int")), "placed")

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("g")
        others, rows = rows[rows["outside"]], rows[~rows["outside"]]
        if not len(rows):
            return pd.DataFrame({"label": pd.Series(dtype="str"), "width": pd.Series(dtype="int32"), "shard": pd.Series(dtype="int32"), "shards": pd.Series(dtype="int32"),
                                 "graph": pd.Series(dtype="object"), "members": pd.Series(dtype="object")})
        graph = Graph(_stack(rows["v"]), least=least, others=_stack(others["v"]) if len(others) else None)
        members = np.stack([rows["g"].to_numpy(), rows["n"].to_numpy()])[:, graph.order]
        return pd.DataFrame({"label": [key[0]], "width": [key[1]], "shard": [key[2]], "shards": [int(rows["shards"].iloc[0])], "graph": [graph.to_bytes()], "members": [members.tobytes()]})

    graphs = _with_queries(placed).groupBy("label", "width", "shard").applyInPandas(build, "label string, width int, shard int, shards int, graph binary, members binary")
    graphs = materialize(graphs, "graphs")
    every = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    asked = placed.select("label", "width", F.col("shard").alias("block"), "g", "v", every.alias("shard"))
    offered = graphs.select("label", "width", "shard", "graph", "members", every.alias("block"))

    def query(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64"), "n": pd.Series(dtype="Int64")})
        graph = Graph.from_bytes(right["graph"].iloc[0])
        ids, counts = np.frombuffer(right["members"].iloc[0], np.int64).reshape(2, -1)
        left = left.sort_values("g")
        own = left["g"].to_numpy()
        label = {}

        def root(x: int) -> int:
            while label.setdefault(x, x) != x:
                label[x] = label[label[x]]
                x = label[x]
            return x

        totals = []
        for g, hit in zip(own.tolist(), graph.within(_stack(left["v"]), least)):
            hit = hit[ids[hit] != g]
            if len(hit):
                totals.append((g, g, int(counts[hit].sum())))
                here = root(g)
                for other in ids[hit].tolist():
                    there = root(other)
                    if there != here:
                        label[max(here, there)] = here = min(here, there)
        spans = [(x, root(x), None) for x in list(label) if root(x) != x]
        out = pd.DataFrame(totals + spans, columns=["a", "b", "n"])
        return out.astype({"a": "int64", "b": "int64", "n": "Int64"})

    keys = ["label", "width", "shard", "block"]
    return asked.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInPandas(query, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, least: float = LEAST, capacity: int = CAPACITY) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row.

    Vectors are compared within a label and a length. Null, zero and non-finite
    vectors and those without a label link with nothing. Repeated rows are
    vectors of their own that link with each other. A component whose vec_ids
    are all null keeps none. An empty table gives no rows; extra columns are
    ignored.
    """
    rows = materialize(_identified(vectors), "vectors")
    groups = rows.where("g is not null").groupBy("g").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id"))
    groups = materialize(groups, "groups")
    links = materialize(_links(groups, least, capacity), "links")
    counts = links.where("n is not null").groupBy("a").agg(F.sum("n").alias("links")).withColumnRenamed("a", "g")
    labels = connected_components(links.where("n is null").select("a", "b")).withColumnRenamed("node", "g")
    named = groups.select("g", "n", "first_id").join(labels, "g", "left").join(counts, "g", "left")
    named = materialize(named.select("g", "first_id", F.coalesce("component", "g").alias("component"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "named")
    least_id = materialize(named.groupBy("component").agg(F.min("first_id").alias("component_id")), "least")
    known = materialize(named.join(least_id, "component").select("g", "n_links", "component_id"), "known")
    component = F.when(F.col("g").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.select("vec_id", "g").join(known, "g", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
