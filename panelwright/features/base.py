"""Fitted models whose state is a small dictionary plus tables, with Spark ML persistence."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame

from panelwright.sources.scratch import materialize


class FitError(ValueError):
    """The training table does not meet a bound or lacks a value that the fit needs."""


class StateModel(Model, MLWritable, MLReadable):
    """A fitted step: ``state`` holds bounded values, ``tables`` holds data that may grow.

    Nothing of a table that the model is applied to enters the state.
    """

    def __init__(self, state: dict | None = None, tables: dict[str, DataFrame] | None = None):
        super().__init__()
        self.state = state or {}
        self.tables = tables or {}

    def write(self) -> MLWriter:
        return _StateWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StateReader(cls)


class _StateWriter(MLWriter):
    def __init__(self, instance: StateModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        extra = {"state": self.instance.state, "tables": sorted(self.instance.tables)}
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata=extra)
        for name, table in self.instance.tables.items():
            table.write.parquet(f"{path}/tables/{name}")


class _StateReader(MLReader):
    def __init__(self, cls: type[StateModel]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> StateModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        tables = {n: self.sparkSession.read.parquet(f"{path}/tables/{n}") for n in meta["tables"]}
        model = self.cls(meta["state"], tables)
        model._resetUid(meta["uid"])
        return model


class StateEstimator(Estimator):
    """Base for estimators that keep their settings as plain attributes."""


def freeze(df: DataFrame, label: str) -> DataFrame:
    """Write a fitted table once, so that every later application reads the same values."""
    return materialize(df, label)
