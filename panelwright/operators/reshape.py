"""Reshaping, pairs and sampling."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelwright.operators.scale import hash_key, join_lookup, running_totals
from panelwright.sources.scratch import materialize

# Columns with no more distinct values than this are ranked without a join.
FEW_VALUES = 64


def to_wide(panel: DataFrame, index: str, series: str, values: Sequence, value: str) -> DataFrame:
    """One column per listed series; for the edge of a job only, panels stay long inside it."""
    return panel.groupBy(index).pivot(series, list(values)).agg(F.first(value, ignorenulls=True))


def to_long(wide: DataFrame, index: Sequence[str], series: str, value: str, columns: Sequence[str] | None = None,
            keep_null: bool = False) -> DataFrame:
    """One row per index and former column."""
    chosen = list(columns) if columns else [c for c in wide.columns if c not in index]
    out = wide.unpivot(list(index), chosen, series, value)
    return out if keep_null else out.where(F.col(value).isNotNull())


def normalise_panel(df: DataFrame, day: str, series: str, value: str) -> DataFrame:
    """Canonical long daily form of a table that is either long already or has one column per series."""
    long = df if series in df.columns else to_long(df, [day], series, value)
    return long.select(F.to_date(day).alias(day), F.col(series).cast("string").alias(series),
                       F.col(value).cast("double").alias(value))


def seeded_sample(df: DataFrame, id_cols: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` rows without replacement in hash order: the same rows under any partitioning."""
    return df.withColumn("_h", hash_key(*id_cols, seed=seed)).orderBy("_h", *id_cols).limit(n).drop("_h")


def _known_rank(value: Column, counts: Sequence[tuple[float, int]]) -> Column:
    """Average rank of a value among few sorted values with counts, by a balanced tree of comparisons."""
    ends = list(accumulate(n for _, n in counts))

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(ends[low] - counts[low][1] + (counts[low][1] + 1) / 2)
        mid = (low + high) // 2
        return F.when(value > F.lit(counts[mid][0]), search(mid + 1, high)).otherwise(search(low, mid))

    return F.when(value.isNotNull(), search(0, len(counts) - 1))


def spearman_matrix(df: DataFrame, columns: Sequence[str], id_cols: Sequence[str]) -> DataFrame:
    """Upper-triangle Spearman correlations (i < j): average ranks, then one aggregation.

    Only rows without NULL in any column count; ``id_cols`` name a row. Ranks come
    from the value counts of one long table, so no column is sorted in one task and
    the number of shuffles does not depend on the columns. Columns of at most
    ``FEW_VALUES`` values get their ranks in place and are not part of the long rows
    that meet their ranks and each other by shuffles. A constant column gives NULL.
    """
    keys, values = [f"_id_{k}" for k in range(len(id_cols))], [f"_value_{i}" for i in range(len(columns))]
    base = df.na.drop(subset=list(columns)).select(*[F.col(c).alias(k) for c, k in zip(id_cols, keys, strict=True)],
                                                   *[F.col(c).cast("double").alias(v) for c, v in zip(columns, values, strict=True)])
    long = base.select(F.posexplode(F.array(*values)).alias("_col", "_value")).where(F.col("_value").isNotNull())
    freq = materialize(long.groupBy("_col", "_value").agg(F.count(F.lit(1)).alias("n")), "value-counts")
    few = [r["_col"] for r in freq.groupBy("_col").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") <= FEW_VALUES).collect()]
    known: dict[int, list] = {i: [] for i in few}
    for r in freq.where(F.col("_col").isin(few)).orderBy("_col", "_value").collect() if few else []:
        known[r["_col"]].append((r["_value"], r["n"]))
    many = [i for i in range(len(columns)) if i not in known]
    # one row per former row; a rank grows with its value, so the largest value of an id has its largest rank
    top = {i: F.max(values[i]).alias(f"_rank_{i}") for i in known}
    if many:
        ranked = running_totals(freq.where(F.col("_col").isin(many)), "_value", ["n"], ["_col"]).select(
            "_col", "_value", F.col("n").alias("_n"), (F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2).alias("_rank"))
        first = [F.when(F.col("_at") == 0, F.col(values[i])).alias(values[i]) for i in known]
        rows = base.select("*", F.posexplode(F.array(*[values[i] for i in many])).alias("_at", "_value")).select(
            *keys, *first, F.get(F.array(*[F.lit(i) for i in many]), F.col("_at")).alias("_col"), "_value")
        base = join_lookup(rows, ranked, ["_col", "_value"], "_n", keys)
        top |= {i: F.max(F.when(F.col("_col") == i, F.col("_rank"))).alias(f"_rank_{i}") for i in many}
    ranked = base.groupBy(*keys).agg(*top.values()).withColumns({f"_rank_{i}": _known_rank(F.col(f"_rank_{i}"), v) for i, v in known.items()})
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1, len(columns))]
    ranks = [f"_rank_{i}" for i in range(len(columns))]
    stats = ranked.agg(
        *[F.covar_pop(ranks[i], ranks[j]).alias(f"c{i}_{j}") for i, j in pairs],
        *[F.stddev_pop(r).alias(f"s{i}") for i, r in enumerate(ranks)])
    return stats.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(columns[i]).alias("a"), F.lit(columns[j]).alias("b"),
                 (F.col(f"c{i}_{j}") / F.nullif(F.col(f"s{i}") * F.col(f"s{j}"), F.lit(0.0))).alias("rho"))
        for i, j in pairs])).alias("p")).select("p.*")


def correlated_pairs(pairs: DataFrame, threshold: float) -> DataFrame:
    return pairs.where(F.abs("rho") > threshold)


def collinear_columns(pairs: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Columns to drop: those that correlate beyond the threshold with an earlier one, with all partners."""
    high = correlated_pairs(pairs, threshold)
    dropped = high.select(F.col("b").alias("column")).distinct()
    partner = high.select(F.col("a").alias("column"), F.col("b").alias("p")).unionByName(
        high.select(F.col("b").alias("column"), F.col("a").alias("p")))
    return dropped.join(partner, "column").groupBy("column").agg(F.array_sort(F.collect_set("p")).alias("partners"))


def constant_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with one value: equal minimum and maximum and no NULL beside it."""
    row = df.agg(*[(F.min(c).eqNullSafe(F.max(c))).alias(c) for c in columns]).first()
    return [c for c in columns if row[c]]


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence, k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per key; Spark cuts every partition to k rows per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence, payload: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``: a struct minimum, which combines before the shuffle."""
    first = F.min(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], *payload))
    return df.groupBy(*keys).agg(first.alias("_f")).select(*keys, *[F.col(f"_f.{c}").alias(c) for c in payload])
