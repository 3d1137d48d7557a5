"""Escape hatches for user code: aggregates, row functions and per-series functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F


def user_aggregate(df: DataFrame, keys: Sequence[str], value: str, partial: Callable[[np.ndarray], list[float]],
                   merge: Callable[[list[float], list[float]], list[float]], finish: Callable[[list[float]], float],
                   out: str) -> DataFrame:
    """Opaque Python aggregate in partial form, so that a hot group is never gathered.

    Workers reduce each Arrow batch to one short state per key; only the states
    are shuffled, merged by key and finished.
    """
    keys = list(keys)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)

    def reduce_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states: dict = {}
        for pdf in batches:
            for key, group in pdf.groupby(keys, dropna=False)[value]:
                state = partial(group.to_numpy())
                states[key] = merge(states[key], state) if key in states else state
        if states:
            frame = pd.DataFrame(list(states), columns=keys)
            frame["_state"] = list(states.values())
            yield frame

    def merge_states(pdf: pd.DataFrame) -> pd.DataFrame:
        states = [list(s) for s in pdf["_state"]]
        total = states[0]
        for s in states[1:]:
            total = merge(total, s)
        return pdf[keys].iloc[:1].assign(**{out: float(finish(total))})

    partials = df.select(*keys, value).mapInPandas(reduce_batches, f"{types}, _state array<double>")
    return partials.groupBy(*keys).applyInPandas(merge_states, f"{types}, {out} double")


def row_function(fn: Callable[[pd.DataFrame], pd.Series], inputs: Sequence[str], returns: str) -> Column:
    """Opaque row code over Arrow batches of the named columns; native expressions come first."""
    names = list(inputs)

    def run(*columns: pd.Series) -> pd.Series:
        batch = pd.concat(columns, axis=1)
        batch.columns = names
        return fn(batch)

    return F.pandas_udf(run, returns)(*names)


def per_series(panel: DataFrame, keys: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, day: str = "day") -> DataFrame:
    """Opaque code per series of a daily panel, rows in day order; a series is bounded by the calendar."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return fn(pdf.sort_values(day).reset_index(drop=True))

    return panel.groupBy(*keys).applyInPandas(run, schema)


class RatioFeature(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Example of a user transformer that saves and loads with a pipeline: one guarded ratio column."""

    part = Param(Params._dummy(), "part", "numerator column", TypeConverters.toString)
    total = Param(Params._dummy(), "total", "denominator column", TypeConverters.toString)
    output = Param(Params._dummy(), "output", "output column", TypeConverters.toString)

    def __init__(self, part: str = "part", total: str = "total", output: str = "ratio"):
        super().__init__()
        self._set(part=part, total=total, output=output)

    def _transform(self, df: DataFrame) -> DataFrame:
        from panelwright.functions.expr import guarded_ratio

        p, t = F.col(self.getOrDefault(self.part)), F.col(self.getOrDefault(self.total))
        return df.withColumn(self.getOrDefault(self.output), guarded_ratio(p, t))
