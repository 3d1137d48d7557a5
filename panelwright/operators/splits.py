"""Hold-outs, folds and resamples that do not depend on the partitioning."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelwright.operators.scale import hash_key, hash_number, join_lookup, numbered_by_hash

# Bits of the digest that make a uniform number.
BITS = 52


def _poisson_one(limit: float = 2.0**-BITS) -> tuple[float, ...]:
    """Cumulative probabilities of a Poisson(1) count of 0, 1, 2, ... up to the resolution of the hash."""
    term, out = math.exp(-1.0), []
    total, k = term, 0
    while 1.0 - total > limit:
        out.append(total)
        k += 1
        term /= k
        total += term
    return tuple(out)


POISSON_ONE = _poisson_one()


def uniform(*id_cols: str, seed: int | str = 0) -> Column:
    """A number in [0, 1) that only depends on the seed and the key: 52 bits of the digest."""
    return F.conv(F.substring(hash_key(*id_cols, seed=seed), 1, BITS // 4), 16, 10).cast("long") / F.lit(2.0**BITS)


def holdout(id_cols: Sequence[str], share: float, seed: int = 0) -> Column:
    """True for the hold-out rows."""
    return uniform(*id_cols, seed=seed) < share


def stratified_holdout(df: DataFrame, id_cols: Sequence[str], label: str, share: float, seed: int = 0,
                       out: str = "is_valid") -> DataFrame:
    """Hold out the rounded share of every label, in hash order."""
    numbered = numbered_by_hash(df, id_cols, [label], seed, "_no", "_n")
    return numbered.withColumn(out, F.col("_no") <= F.round(F.col("_n") * F.lit(share))).drop("_no", "_n")


def stratified_folds(df: DataFrame, id_cols: Sequence[str], label: str, k: int, seed: int = 0,
                     out: str = "fold") -> DataFrame:
    """Deal the rows of every label in hash order to ``k`` folds of near-equal size."""
    numbered = numbered_by_hash(df, id_cols, [label], seed, "_no")
    return numbered.withColumn(out, ((F.col("_no") - 1) % k).cast("int")).drop("_no")


def group_fold(group_cols: Sequence[str], k: int, seed: int = 0) -> Column:
    """Fold of a whole group, without any shuffle."""
    return (hash_number(hash_key(*group_cols, seed=seed)) % k).cast("int")


def stratified_group_folds(df: DataFrame, group_cols: Sequence[str], label: str, k: int, seed: int = 0, out: str = "fold") -> DataFrame:
    """Whole groups dealt to ``k`` folds so that size and label rate stay near equal.

    Groups are put into strata by their size and number of positive labels; each
    stratum is dealt in hash order, starting at a fold of its own. The group
    table has one row a group and joins back by the group's key.
    """
    groups = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(label).cast("long")).alias("_pos"))
    strata = groups.withColumn("_size", F.least(F.col("_n"), F.floor(F.log2("_n") * 4) + 16)).withColumn("_share", F.coalesce(F.round(F.col("_pos") / F.col("_n") * 20), F.lit(-1)))
    numbered = numbered_by_hash(strata, list(group_cols), ["_size", "_share"], seed, "_no")
    shift = hash_number(hash_key("_size", "_share", seed=seed))
    folds = numbered.withColumn(out, ((F.col("_no") - 1 + shift) % k).cast("int")).select(*group_cols, "_n", out)
    return join_lookup(df, folds, group_cols, "_n").drop("_n")


def fold_balance(df: DataFrame, fold: str, label: str) -> DataFrame:
    """Rows and label rate per fold."""
    return df.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("label_rate"))


def bootstrap_weight(id_cols: Sequence[str], resample: int, seed: int = 0) -> Column:
    """How often a row occurs in a bootstrap resample: a Poisson(1) count from the hash."""
    u = uniform(*id_cols, seed=f"{seed}.{resample}")

    def count(x: Column) -> Column:
        found = F.when(x.isNull(), F.lit(None).cast("int"))
        for k, p in enumerate(POISSON_ONE):
            found = found.when(x < p, k)
        return found.otherwise(len(POISSON_ONE))

    # as an element of an array the number is made once a row, not once for every threshold
    return F.get(F.transform(F.array(u), count), F.lit(0))


def time_split(day: Column, cut) -> Column:
    """``train`` before the cut-off day, ``valid`` from it on."""
    return F.when(day < F.lit(cut).cast("date"), F.lit("train")).otherwise(F.lit("valid"))
