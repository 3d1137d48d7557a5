"""Joins with checks, defaults and fallbacks.

Base tables join without hints: at run time Spark measures the smaller side and
either broadcasts it or splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelwright.operators.scale import exact_quantiles, join_lookup


class DuplicateKeysError(ValueError):
    """The right side of a many-to-one join repeats a key."""


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key repeats; the check aggregates in the cluster and returns at most ten keys."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).limit(10).collect()
    if repeated:
        raise DuplicateKeysError(f"keys {list(keys)} are not unique, e.g. {[tuple(r) for r in repeated]}")


def join_many_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str],
                     fill: Mapping[str, object] | None = None) -> DataFrame:
    """Validated left join; optional fills for the right-hand columns of unmatched rows."""
    assert_unique(right, keys)
    out = left.join(right, list(keys), "left")
    return out.na.fill(dict(fill)) if fill else out


def join_fill_zero(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join with 0.0 for every missing right-hand value."""
    return left.join(right, list(keys), "left").na.fill(0.0, subset=[c for c in right.columns if c not in keys])


def outer_fill_zero(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on the keys with 0.0 for every missing value."""
    out = left.join(right, list(keys), "full_outer")
    return out.na.fill(0.0, subset=[c for c in out.columns if c not in keys])


def lookup(df: DataFrame, table: DataFrame, keys: Sequence[str], value: str, default, count_col: str | None = None) -> DataFrame:
    """Map keys through a fitted table; unseen or NULL keys get the default.

    Give ``count_col`` when the table was aggregated from rows like ``df``: it
    names the row count per key, by which hot keys are spread.
    """
    if count_col:
        joined = join_lookup(df, table.select(*keys, value, F.col(count_col).alias("_n")), keys, "_n").drop("_n")
    else:
        joined = df.join(table.select(*keys, value), list(keys), "left")
    return joined.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def fill_from_groups(df: DataFrame, train: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Fill NULLs with the training group's median, else with the training table's median."""
    group = exact_quantiles(train, [value], [0.5], keys).select(
        *keys, F.col("q0").alias("_group_median"), F.col("n_values").alias("_n"))
    overall = exact_quantiles(train, [value], [0.5]).select(F.col("q0").alias("_median"))
    joined = join_lookup(df, group, keys, "_n").join(F.broadcast(overall))  # one row
    return joined.withColumn(value, F.coalesce(value, "_group_median", "_median")).drop("_group_median", "_median", "_n")


def coverage(want: DataFrame, have: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many wanted keys are missing and how many present keys are extra."""
    w, h = want.select(*keys).distinct(), have.select(*keys).distinct()
    missing = w.join(h, list(keys), "left_anti").agg(F.count(F.lit(1)).alias("n_missing"))
    extra = h.join(w, list(keys), "left_anti").agg(F.count(F.lit(1)).alias("n_extra"))
    return missing.join(F.broadcast(extra))  # one row each
