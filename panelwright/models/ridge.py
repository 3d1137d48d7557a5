"""Many-target ridge: one shared design by day, one target per series."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from panelwright.features.base import FitError
from panelwright.operators.metrics import rmse, rmsle
from panelwright.sources.scratch import materialize

class ManyTargetRidge:
    """Closed-form ridge with intercept for every series of a dense panel.

    The design table has one row per day and is collected: days x regressors
    numbers, bounded by the calendar. The panel is not: each series is reduced to
    its values in day order, and coefficients are one matrix product per Arrow
    batch. With more regressors than days the system is solved in its dual form
    (days x days). ``scaled`` columns are standardised, NULLs in them take the
    training median; the penalty leaves the intercept free. One fit serves a
    whole grid of penalties.
    """

    def __init__(self, keys: Sequence[str], value: str, columns: Sequence[str], scaled: Sequence[str] | None = None,
                 day: str = "day"):
        self.keys, self.value, self.columns, self.day = list(keys), value, list(columns), day
        self.scaled = set(columns if scaled is None else scaled)
        self.alpha: float | None = None

    def _raw(self, design: DataFrame) -> tuple[list, np.ndarray]:
        """Days in order and their regressors, NaN for NULL."""
        rows = design.select(self.day, F.array(*[F.col(f"`{c}`").cast("double") for c in self.columns]).alias("_x")).orderBy(self.day).collect()
        return [r[self.day] for r in rows], np.array([r["_x"] for r in rows], dtype=float).reshape(len(rows), len(self.columns))

    def _x(self, design: DataFrame) -> tuple[list, np.ndarray]:
        """Days in order and their centred, scaled regressors."""
        days, x = self._raw(design)
        return days, (np.where(np.isnan(x), self.median, x) - self.mean) / self.scale

    def fit(self, panel: DataFrame, design: DataFrame) -> "ManyTargetRidge":
        """``design`` holds the training days; every series must have a value on each of them."""
        days, raw = self._raw(design)
        known = ~np.isnan(raw).all(0)
        self.median = np.zeros(raw.shape[1])
        self.median[known] = np.nanmedian(raw[:, known], axis=0)
        full = np.where(np.isnan(raw), self.median, raw)
        self.n_days, self.mean, spread = len(days), full.mean(0), full.std(0)
        chosen = np.array([c in self.scaled for c in self.columns], bool)
        self.scale = np.where(chosen & (spread > 0), spread, 1.0)
        self.x = (full - self.mean) / self.scale
        numbers = panel.sparkSession.createDataFrame([(d, i) for i, d in enumerate(days)], f"`{self.day}` {design.select(self.day).schema[0].dataType.simpleString()}, _no int")
        joined = panel.select(*self.keys, self.day, self.value).join(F.broadcast(numbers), self.day)  # one row per calendar day
        # a series' values, bounded by the calendar
        listed = F.array_sort(F.collect_list(F.when(F.col(self.value).isNotNull(), F.struct("_no", F.col(self.value).cast("double").alias("v")))))
        self.values = materialize(joined.groupBy(*self.keys).agg(listed.alias("_y"), F.avg(self.value).alias("_mean")).withColumn("_y", F.col("_y.v")), "ridge-values")
        if not self.values.where(F.size("_y") != self.n_days).isEmpty():
            raise FitError("every series needs a value on every training day; fill the panel first")
        return self

    def _solver(self, alpha: float) -> np.ndarray:
        """The matrix (days x regressors) that turns a series' values into its coefficients."""
        n, p = self.x.shape
        if p > n:
            return np.linalg.pinv(self.x @ self.x.T + alpha * np.eye(n), hermitian=True) @ self.x
        return self.x @ np.linalg.pinv(self.x.T @ self.x + alpha * np.eye(p), hermitian=True)

    def coefficients(self, alphas: Sequence[float]) -> DataFrame:
        """Per series and penalty the intercept and the coefficients on the scaled columns."""
        shared = self.values.sparkSession.sparkContext.broadcast([(float(a), self._solver(a)) for a in alphas])
        keys = self.keys

        def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if pdf.empty:
                    continue
                y = np.stack(pdf["_y"].to_numpy())
                for a, m in shared.value:
                    yield pdf[keys].assign(alpha=a, intercept=pdf["_mean"], coef=list(y @ m))

        types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.values.select(*keys).schema.fields)
        return self.values.mapInPandas(solve, f"{types}, alpha double, intercept double, coef array<double>")

    def named_coefficients(self, alpha: float | None = None) -> DataFrame:
        """Long table (series, term, coefficient) on the original scale of the columns."""
        c = self.coefficients([self._alpha(alpha)])
        scale = F.array(*[F.lit(float(s)) for s in self.scale])
        raw = F.zip_with("coef", scale, lambda b, s: b / s)
        names = F.array(*[F.lit(n) for n in self.columns])
        shift = F.aggregate(F.zip_with(raw, F.array(*[F.lit(float(m)) for m in self.mean]), lambda b, m: b * m),
                            F.lit(0.0), lambda acc, v: acc + v)
        pairs = F.concat(F.array(F.struct(F.lit("intercept").alias("term"), (F.col("intercept") - shift).alias("coefficient"))),
                         F.zip_with(names, raw, lambda n, b: F.struct(n.alias("term"), b.alias("coefficient"))))
        return c.select(*self.keys, F.explode(pairs).alias("p")).select(*self.keys, "p.term", "p.coefficient")

    def _alpha(self, alpha: float | None) -> float:
        chosen = self.alpha if alpha is None else alpha
        if chosen is None:
            raise FitError("no penalty chosen; pass alpha or search first")
        return chosen

    def predict(self, design: DataFrame, alpha: float | None = None, out: str = "baseline") -> DataFrame:
        """Predictions of every series for the days of ``design``."""
        return self._score(self.coefficients([self._alpha(alpha)]), design, out).drop("alpha")

    def _score(self, coef: DataFrame, design: DataFrame, out: str) -> DataFrame:
        days, x = self._x(design)
        shared, keys, day = coef.sparkSession.sparkContext.broadcast((days, x.T)), self.keys, self.day

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            dates, xt = shared.value
            for pdf in batches:
                for at in range(0, len(pdf), 256):
                    part = pdf.iloc[at:at + 256]
                    y = np.stack(part["coef"].to_numpy()) @ xt + part["intercept"].to_numpy()[:, None]
                    rows = part[[*keys, "alpha"]].loc[part.index.repeat(len(dates))].reset_index(drop=True)
                    rows[day] = list(dates) * len(part)
                    rows[out] = y.ravel()
                    yield rows

        types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coef.select(*keys).schema.fields)
        kind = design.select(self.day).schema[0].dataType.simpleString()
        return coef.mapInPandas(score, f"{types}, alpha double, `{day}` {kind}, `{out}` double")

    def search(self, panel: DataFrame, design: DataFrame, alphas: Sequence[float]) -> DataFrame:
        """Hold-out RMSLE (both sides clipped) and RMSE per penalty; the best one is kept in ``alpha``."""
        scored = self._score(self.coefficients(alphas), design, "_p").join(
            panel.where(F.col(self.value).isNotNull()).select(*self.keys, self.day, self.value), [*self.keys, self.day])
        table = materialize(scored.groupBy("alpha").agg(
            rmsle(F.col(self.value), F.col("_p")).alias("rmsle"), rmse(F.col(self.value), F.col("_p")).alias("rmse")), "ridge-search")
        self.alpha = table.orderBy("rmsle", "alpha").first()["alpha"]
        return table


class SeriesRidge:
    """Ridge with intercept of every series on regressors of its own, such as its lags.

    Each series is solved from its rows, one a calendar day. Regressors are
    standardised per series; a constant one gets coefficient zero.
    """

    def __init__(self, keys: Sequence[str], value: str, columns: Sequence[str], alpha: float = 10.0):
        self.keys, self.value, self.columns, self.alpha = list(keys), value, list(columns), alpha

    def fit(self, rows: DataFrame) -> "SeriesRidge":
        """Rows with a NULL in the value or a regressor do not count."""
        keys, value, columns, alpha = self.keys, self.value, self.columns, self.alpha
        used = rows.select(*keys, F.col(value).cast("double").alias("_y"), F.array(*[F.col(f"`{c}`").cast("double") for c in columns]).alias("_x"))
        used = used.where(F.col("_y").isNotNull() & F.forall("_x", lambda v: v.isNotNull()))

        def solve(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            x, y = np.stack(pdf["_x"].to_numpy()).astype(float), pdf["_y"].to_numpy()
            scale = x.std(0)
            z = (x - x.mean(0)) / np.where(scale > 0, scale, 1.0)
            coef = np.linalg.pinv(z.T @ z + alpha * np.eye(len(columns)), hermitian=True) @ (z.T @ (y - y.mean()))
            coef = coef / np.where(scale > 0, scale, 1.0)
            return pd.DataFrame([[*key, y.mean() - coef @ x.mean(0), coef.tolist()]], columns=[*keys, "_intercept", "_coef"])

        types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema.fields)
        self.table = materialize(used.groupBy(*keys).applyInPandas(solve, f"{types}, _intercept double, _coef array<double>"), "series-ridge")
        return self

    def predict(self, rows: DataFrame, out: str = "baseline") -> DataFrame:
        """Keys, day and prediction; a NULL regressor counts as zero. Series without a fit are left out."""
        x = F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in self.columns])
        dot = F.aggregate(F.zip_with("_coef", "_x", lambda a, b: a * b), F.col("_intercept"), lambda acc, v: acc + v)
        return rows.select(*self.keys, "day", x.alias("_x")).join(self.table, self.keys).select(*self.keys, "day", dot.alias(out))


def log_grid(low: float, high: float, steps: int) -> list[float]:
    return [float(v) for v in np.logspace(np.log10(low), np.log10(high), steps)]
