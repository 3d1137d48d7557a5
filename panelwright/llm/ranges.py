"""Ranges of a long column as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def long_table(values: Sequence[int]) -> Column:
    """A constant array that the optimiser folds; its plan stays one literal however long it is."""
    return F.split(F.lit(",".join(str(v) for v in values)), ",").cast("array<long>")


def range_of(value: Column, edges: Sequence[int]) -> Column:
    """How many of the sorted ``edges`` lie at or below ``value``, by binary search in a constant array."""
    if not edges:
        return F.lit(0)
    table, last = long_table(edges), len(edges)
    steps = [1 << k for k in range(last.bit_length() - 1, -1, -1)]

    def advance(at: Column, step: Column) -> Column:
        below = F.element_at(table, F.least(at + step, F.lit(last))) <= value
        return F.when((at + step <= last) & below, at + step).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)
