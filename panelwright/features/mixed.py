"""Mixed-column preprocessor with split, imputation, encoding, optional scaling and a log target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, functions as F

from panelwright.features.steps import DomainOneHot, DomainOneHotModel, PopulationScaler, SimpleImputer, assemble
from panelwright.functions.expr import route_by_type
from panelwright.operators.splits import holdout


class MixedPreprocessor:
    """``fit_split`` returns the prepared training and hold-out tables; the fit only sees training rows."""

    def __init__(self, target: str, id_cols: Sequence[str], test_share: float = 0.2, seed: int = 42,
                 scale_numeric: bool = False):
        self.target, self.id_cols = target, list(id_cols)
        self.test_share, self.seed, self.scale_numeric = test_share, seed, scale_numeric
        self.model: PipelineModel | None = None
        self.numeric: list[str] = []
        self.text: list[str] = []

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        valid = holdout(self.id_cols, self.test_share, self.seed)
        return df.where(~valid), df.where(valid)

    def fit(self, train: DataFrame) -> "MixedPreprocessor":
        numeric, text = route_by_type(train)
        skip = {self.target, *self.id_cols}
        self.numeric, self.text = [c for c in numeric if c not in skip], [c for c in text if c not in skip]
        stages = [SimpleImputer(self.numeric, self.text, text_fill="MISSING")]
        if self.scale_numeric:
            stages.append(PopulationScaler(self.numeric))
        stages.append(DomainOneHot(self.text))
        self.model = Pipeline(stages=stages).fit(train)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Prepared features with the log1p target as ``label`` where the target is present."""
        out = self.model.transform(df)
        return out.withColumn("label", F.log1p(self.target)).drop(self.target) if self.target in df.columns else out

    def fit_split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        train, valid = self.split(df)
        self.fit(train)
        return self.transform(train), self.transform(valid)

    def feature_names(self) -> list[str]:
        encoder = next(s for s in self.model.stages if isinstance(s, DomainOneHotModel))
        return self.numeric + encoder.names()

    def vectors(self, df: DataFrame) -> DataFrame:
        return assemble(df, self.feature_names())
