"""Drift between a baseline and a current table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def level_shares(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of every level (per group)."""
    counts = df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.groupBy(*by).agg(F.sum("_n").alias("_t"))
    joined = counts.join(totals, list(by)) if by else counts.join(F.broadcast(totals))  # one row without groups
    return joined.select(*by, column, (F.col("_n") / F.col("_t")).alias("share"))


def categorical_drift(baseline: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """Largest absolute difference of level shares; levels of only one side count with share 0."""
    b = level_shares(baseline, column).withColumnRenamed("share", "_b")
    c = level_shares(current, column).withColumnRenamed("share", "_c")
    gap = F.abs(F.coalesce("_b", F.lit(0.0)) - F.coalesce("_c", F.lit(0.0)))
    return b.join(c, column, "full_outer").agg(F.max(gap).alias("l_infinity"), F.count(F.lit(1)).alias("n_levels"))


def bin_index(value: Column, low: float, high: float, bins: int) -> Column:
    """Equal-width bin over the baseline's range; values beyond it fall into the outer bins."""
    width = (high - low) / bins or 1.0
    return F.least(F.greatest(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(0)), F.lit(bins - 1)).cast("int")


def jensen_shannon(p: Column, q: Column) -> Column:
    """One bin's term of the Jensen-Shannon divergence (natural logarithm)."""
    m = (p + q) / 2
    def part(x):
        return F.when(x > 0, x * F.log(x / m)).otherwise(F.lit(0.0))
    return (part(p) + part(q)) / 2


def numeric_drift(baseline: DataFrame, current: DataFrame, column: str, low: float, high: float, bins: int = 20) -> DataFrame:
    """Jensen-Shannon divergence of the binned distributions."""
    binned = bin_index(F.col(column), low, high, bins).alias("_bin")
    b = level_shares(baseline.where(F.col(column).isNotNull()).select(binned), "_bin").withColumnRenamed("share", "_p")
    c = level_shares(current.where(F.col(column).isNotNull()).select(binned), "_bin").withColumnRenamed("share", "_q")
    term = jensen_shannon(F.coalesce("_p", F.lit(0.0)), F.coalesce("_q", F.lit(0.0)))
    return b.join(c, "_bin", "full_outer").agg(F.sum(term).alias("js_divergence"), F.count(F.lit(1)).alias("n_bins"))
