"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelwright.operators.scale import join_lookup
from panelwright.sources.scratch import materialize


def _with_smallest(pairs: DataFrame, hot_rows: int) -> DataFrame:
    """Adds to each (a, b) the smallest b of its a; keys above ``hot_rows`` rows are salted."""
    low = pairs.groupBy("a").agg(F.min("b").alias("low"), F.count(F.lit(1)).alias("n"))
    return join_lookup(pairs, low, ["a"], "n", ["b"], "inner", hot_rows=hot_rows).select("a", "b", "low")


def connected_components(edges: DataFrame) -> DataFrame:
    """The smallest node that each node of ``edges`` (a, b: long) reaches, as (node, component).

    Large-star and small-star steps alternate until every edge points at its
    component's smallest node; each round is written to shared storage. Nodes
    without an edge to another node do not appear. An empty edge table gives an
    empty result. At most two keys a partition count as hot, so the salted list
    is bounded by the number of partitions.
    """
    spark = edges.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    state = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        count, mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (count, mark) == seen or not count:
            break
        seen, hot = (count, mark), max(100, count // (2 * parts))
        both = state.unionAll(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_smallest(both, hot).where("b > a").select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
        large = materialize(large.distinct(), "large-star")
        near = _with_smallest(large, hot)
        small = near.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        state = materialize(small.unionAll(near.select("a", F.col("low").alias("b"))).where("a <> b").distinct(), "small-star")
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
