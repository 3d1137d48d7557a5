"""Exact k nearest neighbours by pivot routing and bounded tiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from panelwright.operators.scale import hash_key, hash_number

MAX_PIVOTS = 64
# Distances that one task holds at a time, and the columns that share a minimum.
BLOCK_CELLS = 1 << 22
GROUP = 64


def nearest_neighbors(queries: DataFrame, corpus: DataFrame, id_col: str, vector: str, k: int,
                      exclude_self: bool = False, tile_rows: int = 32768) -> DataFrame:
    """The ``k`` nearest corpus rows of every query row: (query_id, neighbor_id, distance, rank).

    Vectors are assigned to the nearest of a bounded set of pivots. The triangle
    inequality gives each query cell a bound on its k-th distance, and corpus
    rows travel only to cells they can matter to. Cells are cut by hash into
    tiles of about ``tile_rows`` rows, a tile pair returns k rows per query, and
    these partial lists are merged. Exact: nothing is capped or skipped. A row
    travels once per tile of the other side, so large tiles move less; a task
    holds two tiles and ``BLOCK_CELLS`` distances.
    """
    n_corpus = corpus.count()
    n_pivots = int(min(MAX_PIVOTS, max(1, n_corpus // tile_rows)))
    picked = corpus.select(F.col(vector).cast("array<double>").alias("v"), id_col).orderBy(
        hash_key(id_col, seed="pivot"), id_col).limit(n_pivots).collect()
    pivots = np.array([r["v"] for r in picked])
    q, c = _assign(queries, id_col, vector, pivots), _assign(corpus, id_col, vector, pivots)

    q_stats = {r["cell"]: r for r in q.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("dist").alias("radius")).collect()}
    c_sizes = {r["cell"]: r["n"] for r in c.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    need = k + (1 if exclude_self else 0)
    closest = Window.partitionBy("cell").orderBy("dist")
    near = c.select("cell", "dist", F.row_number().over(closest).alias("rn")).where(F.col("rn") <= need).collect()

    gaps = np.sqrt(((pivots[:, None, :] - pivots[None, :, :]) ** 2).sum(-1))
    q_tiles = {i: max(1, -(-r["n"] // tile_rows)) for i, r in q_stats.items()}
    c_tiles = {j: max(1, -(-n // tile_rows)) for j, n in c_sizes.items()}
    routes = []
    for i, r in q_stats.items():
        reach = sorted(r["radius"] + gaps[i, x["cell"]] + x["dist"] for x in near)
        bound = reach[need - 1] if len(reach) >= need else float("inf")
        for j in c_sizes:
            # a corpus row at distance s from pivot j can matter only while low <= s <= high
            routes.append((int(i), int(j), int(q_tiles[i]), int(c_tiles[j]),
                           float(gaps[i, j] - r["radius"] - bound), float(gaps[i, j] + r["radius"] + bound)))
    spark = corpus.sparkSession
    route = F.broadcast(spark.createDataFrame(routes, "qc int, cc int, qt int, ct int, low double, high double"))

    slack = 1e-9
    q_side = q.withColumnRenamed("cell", "qc").join(route, "qc").select(
        "qc", "cc", F.pmod("h", "qt").alias("qb"), F.explode(F.sequence(F.lit(0).cast("long"), (F.col("ct") - 1).cast("long"))).alias("cb"),
        F.col("id"), F.col("v"))
    c_side = c.withColumnRenamed("cell", "cc").join(route, "cc").where(
        F.col("dist").between(F.col("low") - slack, F.col("high") + slack)).select(
        "qc", "cc", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("qt") - 1).cast("long"))).alias("qb"), F.pmod("h", "ct").alias("cb"),
        F.col("id"), F.col("v"))
    keys = ["qc", "cc", "qb", "cb"]
    id_type = corpus.schema[id_col].dataType.simpleString()

    def tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _tile_top_k(left, right, k, exclude_self)

    partial = q_side.groupBy(*keys).cogroup(c_side.groupBy(*keys)).applyInPandas(
        tile, f"query_id {id_type}, neighbor_id {id_type}, distance double")
    order = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _assign(df: DataFrame, id_col: str, vector: str, pivots: np.ndarray) -> DataFrame:
    kind = "array<float>" if df.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"  # floats travel as they are
    base = df.select(F.col(id_col).alias("id"), hash_number(hash_key(id_col, seed="tile")).alias("h"),
                     F.col(vector).cast(kind).alias("v"))

    def nearest_pivot(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                v = np.stack(pdf["v"].to_numpy()).astype(float)
                cell = _distances(v, pivots).argmin(axis=1)
                yield pdf.assign(cell=cell.astype("int32"), dist=np.sqrt(((v - pivots[cell]) ** 2).sum(1)))

    id_type = df.schema[id_col].dataType.simpleString()
    return base.mapInPandas(nearest_pivot, f"id {id_type}, h long, v {kind}, cell int, dist double")


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    sq = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * a @ b.T
    return np.sqrt(np.maximum(sq, 0.0))


def _tile_top_k(left: pd.DataFrame, right: pd.DataFrame, k: int, exclude_self: bool) -> pd.DataFrame:
    if left.empty or right.empty:
        return pd.DataFrame({"query_id": left["id"][:0], "neighbor_id": left["id"][:0],
                             "distance": np.empty(0)})
    a, b = (np.stack(side["v"].to_numpy()).astype(float) for side in (left, right))
    names, code = np.unique(np.concatenate([left["id"].to_numpy(), right["id"].to_numpy()]), return_inverse=True)
    lid, rid = code[:len(a)], code[len(a):]
    with np.errstate(over="ignore"):
        norms, own = (b * b).sum(1), (a * a).sum(1)
    lid, a, own = lid[np.isfinite(own)], a[np.isfinite(own)], own[np.isfinite(own)]  # no distance to others is finite
    keep = np.flatnonzero(np.isfinite(norms))
    keep = keep[_first_copies(b[keep], rid[keep], k + (1 if exclude_self else 0))]
    b, rid, norms = b[keep], rid[keep], norms[keep]
    # a row's own term does not change its order, so one product gives |b|^2 - 2ab
    factors = np.concatenate([-2.0 * b.T, norms[None, :]])
    slack = 1e-12 * b.shape[1] * (np.sqrt(own) + np.sqrt(norms.max(initial=0.0))) ** 2
    empty = pd.DataFrame({"query_id": names[:0], "neighbor_id": names[:0], "distance": np.empty(0)})
    parts, step = [empty], max(1, BLOCK_CELLS // max(1, len(rid)))
    for at in range(0, len(lid) if len(rid) else 0, step):
        x, ids = a[at:at + step], lid[at:at + step]
        near = np.concatenate([x, np.ones((len(x), 1))], axis=1) @ factors
        if exclude_self:
            near[_own_cells(ids, rid)] = np.inf
        rows, cols = _near_cells(near, k, slack[at:at + step])
        # the few cells left get their distance from the difference of the vectors: copies tie exactly
        exact = np.concatenate([np.sqrt(((x[rows[i:i + 65536]] - b[cols[i:i + 65536]]) ** 2).sum(1)) for i in range(0, len(rows), 65536)] or [np.empty(0)])
        # ties at the cut are decided by id
        order = np.lexsort((rid[cols], exact, rows))
        rows, cols, exact = rows[order], cols[order], exact[order]
        first = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
        parts.append(pd.DataFrame({"query_id": names[ids[rows[first]]], "neighbor_id": names[rid[cols[first]]], "distance": exact[first]}))
    out = pd.concat(parts, ignore_index=True)
    return out[np.isfinite(out["distance"])]


def _own_cells(lid: np.ndarray, rid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (row, column) of equal ids; an id may come more than once."""
    order = np.argsort(rid, kind="stable")
    low, high = (np.searchsorted(rid[order], lid, side) for side in ("left", "right"))
    rows = np.repeat(np.arange(len(lid)), high - low)
    cols = np.arange(len(rows)) - np.repeat(np.cumsum(high - low) - high, high - low)
    return rows, order[cols]


def _first_copies(b: np.ndarray, rid: np.ndarray, need: int) -> np.ndarray:
    """Positions of the rows that can be among the nearest: of equal vectors, those of the ``need`` smallest ids."""
    if len(b) == 0:
        return np.empty(0, dtype=int)
    group = pd.factorize(np.array([v.tobytes() for v in b + 0.0], dtype=object))[0]
    order = np.lexsort((rid, group))
    g, r = group[order], rid[order]
    fresh = np.append(True, g[1:] != g[:-1])
    step = np.cumsum(fresh | np.append(True, r[1:] != r[:-1]))  # one up at each new id of a group
    return np.sort(order[step - step[fresh][np.cumsum(fresh) - 1] < need])


def _near_cells(near: np.ndarray, k: int, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells (row, column) that hold each row's ``k`` smallest values and all within ``slack`` of the k-th.

    The k-th smallest of the minima of column groups bounds the k-th smallest
    value, so only groups with a minimum below it are looked into.
    """
    n, m = near.shape
    whole = m // GROUP * GROUP
    if whole // GROUP <= 4 * k:
        kth = np.partition(near, k - 1, axis=1)[:, k - 1] if m > k else np.full(n, np.inf)
        return np.nonzero(near <= np.where(np.isfinite(kth), kth + slack, np.finfo(float).max)[:, None])
    minima = near[:, :whole].reshape(n, -1, GROUP).min(axis=2)
    if m > whole:
        minima = np.concatenate([minima, near[:, whole:].min(axis=1, keepdims=True)], axis=1)
    bound = np.partition(minima, k - 1, axis=1)[:, k - 1] + slack
    rows, groups = np.nonzero(minima <= np.where(np.isfinite(bound), bound, np.finfo(float).max)[:, None])
    cols = groups[:, None] * GROUP + np.arange(GROUP)
    inside = cols < m
    values = np.where(inside, near[rows[:, None], np.minimum(cols, m - 1)], np.inf)
    hit = values <= np.where(np.isfinite(bound), bound, np.finfo(float).max)[rows, None]
    return np.repeat(rows, hit.sum(1)), cols[hit]


def vote(neighbors: DataFrame, labels: DataFrame, id_col: str, label: str) -> DataFrame:
    """Majority label of each query's neighbours; ties go to the smallest label."""
    named = neighbors.join(labels.select(F.col(id_col).alias("neighbor_id"), label), "neighbor_id")
    counts = named.groupBy("query_id", label).agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("neg"), label))
    return counts.groupBy("query_id").agg(best.alias("_b")).select("query_id", F.col(f"_b.{label}").alias("prediction"))
