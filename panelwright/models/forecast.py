"""Seasonal baseline, hybrid baseline-plus-residual forecast and the recursive horizon."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, functions as F

from panelwright.features.steps import DomainOneHot, assemble
from panelwright.functions import calendar as K
from panelwright.functions.expr import align_columns, clip
from panelwright.models.ridge import ManyTargetRidge, SeriesRidge
from panelwright.operators import panel as P
from panelwright.sources.scratch import materialize


def day_design(days: DataFrame, start: dt.date, order: int = 1, freq: str = "M", fourier_order: int = 2) -> DataFrame:
    """Trend, weekday and Fourier columns plus a new-year flag for a table of days."""
    cols = K.design_columns(F.col("day"), start, order, weekly=True, freq=freq, fourier_order=fourier_order, intercept=True)
    cols["new_year"] = (F.dayofyear("day") == 1).cast("double")
    return days.select("day", *[c.alias(n) for n, c in cols.items()])


def calendar_days(df: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day of a closed interval."""
    return df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day"))


def seasonal_baseline(panel: DataFrame, keys: Sequence[str], value: str, first: dt.date, last: dt.date, horizon: int,
                      alpha: float = 1e-6) -> DataFrame:
    """Least-squares trend, weekday, monthly Fourier and new-year fit on one window, predicted ``horizon`` days on."""
    window = panel.where(F.col("day").between(F.lit(first), F.lit(last)))
    train = day_design(calendar_days(panel, first, last), first, freq="M", fourier_order=4)
    model = ManyTargetRidge(keys, value, [c for c in train.columns if c != "day"], scaled=[]).fit(window, train)
    ahead = day_design(calendar_days(panel, last + dt.timedelta(1), last + dt.timedelta(horizon)), first, freq="M", fourier_order=4)
    return model.predict(ahead, alpha, "forecast").withColumn("forecast", clip(F.col("forecast"), lower=0.0))


def residuals(panel: DataFrame, baseline: DataFrame, keys: Sequence[str], value: str, out: str = "residual") -> DataFrame:
    """Value minus baseline per series and day."""
    return panel.join(baseline, [*keys, "day"]).withColumn(out, F.col(value) - F.col("baseline"))


class HybridForecast:
    """Ridge baseline over all series plus a boosted-tree model of its residual.

    The residual features are lags of the value, promotion exposure, calendar
    parts and one-hot series; they are aligned to the columns frozen in training.
    """

    def __init__(self, keys: Sequence[str], value: str = "v", promo: str = "promo", lags: int = 7, alpha: float = 10.0,
                 trees: int = 10, depth: int = 4):
        self.keys, self.value, self.promo, self.lags, self.alpha = list(keys), value, promo, lags, alpha
        self.trees, self.depth = trees, depth

    def fit(self, panel: DataFrame) -> "HybridForecast":
        """``panel`` is dense and filled; rows: keys, day, value, promotion flag."""
        self.first, self.last = K.day_bounds(panel, "day")
        design = day_design(calendar_days(panel, self.first, self.last), self.first, order=2, freq="A", fourier_order=4)
        names = [c for c in design.columns if c != "day"]
        self.ridge = ManyTargetRidge(self.keys, self.value, names,
                                     [c for c in names if not c.startswith("s_")]).fit(panel, design)
        baseline = self.ridge.predict(design, self.alpha)
        self.encoder = DomainOneHot(self.keys, keep_input=True).fit(panel)
        rows = materialize(self._features(residuals(panel, baseline, self.keys, self.value)), "hybrid-train")
        self.columns = [c for c in rows.columns if c not in (*self.keys, "day", self.value, "baseline", "residual")]
        usable = rows.na.drop(subset=self.columns)
        data = assemble(usable, self.columns).withColumn("is_late", F.col("day") > F.lit(self.last - dt.timedelta(90)))
        self.trees_model: Model = GBTRegressor(labelCol="residual", maxIter=self.trees, maxDepth=self.depth, stepSize=0.2,
                                               validationIndicatorCol="is_late", seed=7).fit(data)
        return self

    def _features(self, rows: DataFrame) -> DataFrame:
        lagged = rows.withColumns(P.lag_block(self.value, self.lags, self.keys))
        promo = P.promotion_features(rows, self.keys, self.promo)
        full = lagged.join(promo, [*self.keys, "day"]).na.fill(0.0, subset=["onp_expo_0_2", "onp_expo_8_14", "onp_start_lead_0"])
        dated = full.withColumns({"weekday": F.weekday("day").cast("double"), "month": F.month("day").cast("double")}).drop(self.promo)
        return self.encoder.transform(dated)

    def predict_day(self, history: DataFrame, day: dt.date) -> DataFrame:
        """Forecast of every series for one day from a history that holds that day's row with an unknown value."""
        design = day_design(calendar_days(history, day, day), self.first, order=2, freq="A", fourier_order=4)
        baseline = self.ridge.predict(design, self.alpha)
        rows = self._features(history).where(F.col("day") == F.lit(day)).join(baseline, [*self.keys, "day"])
        aligned = align_columns(rows, [*self.keys, "day", "baseline", *self.columns]).na.fill(0.0, subset=self.columns)
        scored = self.trees_model.transform(assemble(aligned, self.columns))
        return scored.select(*self.keys, "day", clip(F.col("baseline") + F.col("prediction"), lower=0.0).alias("forecast"))


class WholeForecast(HybridForecast):
    """Baseline with own lags, driver lags, events and a weekly driver; residual trees with metadata and local events.

    ``driver`` names a panel column whose lags enter the baseline as log(1 + x);
    its future values are forecast first (``driver_forecast``). ``day_table`` has
    one row per day: national events and weekly driver columns; absent days are
    zero. ``metadata`` has one row per series; its text columns are one-hot encoded
    over the given ``domains``. ``place_events`` holds flags per (day, ``place``),
    where ``place`` is a metadata or key column. Without ``trees`` the baseline
    alone is the forecast.
    """

    def __init__(self, keys: Sequence[str], value: str = "v", promo: str = "promo", lags: int = 9, alpha: float = 10.0, trees: int = 10, depth: int = 4,
                 driver: str | None = None, driver_lags: int = 9, day_table: DataFrame | None = None, metadata: DataFrame | None = None,
                 domains: dict[str, list[str]] | None = None, place_events: DataFrame | None = None, place: str | None = None, calendar: bool = True):
        super().__init__(keys, value, promo, lags, alpha, trees, depth)
        self.driver, self.driver_lags, self.calendar = driver, driver_lags, calendar
        self.day_table, self.metadata, self.domains = day_table, metadata, domains or {}
        self.place_events, self.place = place_events, place

    @property
    def reach(self) -> int:
        return max(self.lags, self.driver_lags if self.driver else 0, 2) + 1

    def baseline_rows(self, panel: DataFrame) -> DataFrame:
        """Every row with its baseline regressors."""
        rows = panel.withColumns(P.lag_block(self.value, self.lags, self.keys))
        if self.driver:
            rows = rows.withColumn("_level", F.log1p(self.driver))
            rows = rows.withColumns(P.lag_block("_level", self.driver_lags, self.keys, name="driver")).drop("_level")
        first, last = K.day_bounds(panel, "day")
        if self.calendar:
            rows = rows.join(F.broadcast(day_design(calendar_days(panel, first, last), self.first, order=2, freq="A", fourier_order=4)), "day")
        if self.day_table is not None:
            flags = [c for c in self.day_table.columns if c != "day"]
            rows = rows.join(F.broadcast(self.day_table), "day", "left").na.fill(0.0, flags)  # one row per calendar day
        return rows

    def fit(self, panel: DataFrame) -> "WholeForecast":
        self.first, self.last = K.day_bounds(panel, "day")
        panel_columns = set(panel.columns)
        rows = materialize(self.baseline_rows(panel), "whole-baseline")
        panel = panel.select(*self.keys, "day", self.value, self.promo, *([self.driver] if self.driver else []))
        self.base_columns = [c for c in rows.columns if c not in panel_columns]
        self.ridge = SeriesRidge(self.keys, self.value, self.base_columns, self.alpha).fit(rows)
        self.trees_model = None
        if self.trees:
            known = rows.na.drop(subset=self.base_columns)
            made = self._features(residuals(panel, self.ridge.predict(known), self.keys, self.value))
            made = materialize(made, "whole-residual")
            self.columns = [c for c in made.columns if c not in (*panel.columns, "baseline", "residual")]
            data = assemble(made.na.drop(subset=self.columns), self.columns).withColumn("is_late", F.col("day") > F.lit(self.last - dt.timedelta(90)))
            self.trees_model = GBTRegressor(labelCol="residual", maxIter=self.trees, maxDepth=self.depth, stepSize=0.2,
                                            validationIndicatorCol="is_late", seed=7).fit(data)
        return self

    def _features(self, rows: DataFrame) -> DataFrame:
        """Residual features: lags, exposure, calendar parts, metadata and local events; keys stay, unencoded."""
        lagged = rows.withColumns(P.lag_block(self.value, self.lags, self.keys))
        promo = P.promotion_features(rows, self.keys, self.promo)
        full = lagged.join(promo, [*self.keys, "day"]).na.fill(0.0, subset=["onp_expo_0_2", "onp_expo_8_14", "onp_start_lead_0"])
        full = full.withColumns({"weekday": F.weekday("day").cast("double"), "month": F.month("day").cast("double")}).drop(self.promo, *([self.driver] if self.driver else []))
        if self.metadata is not None:
            full = full.join(self.metadata, [k for k in self.keys if k in self.metadata.columns], "left")
        if self.place_events is not None:
            flags = [c for c in self.place_events.columns if c not in ("day", self.place)]
            full = full.join(self.place_events, ["day", self.place], "left").na.fill(0.0, flags)
        return DomainOneHot(list(self.domains), domains=self.domains).fit(full).transform(full) if self.domains else full

    def predict_day(self, history: DataFrame, day: dt.date) -> DataFrame:
        baseline = self.ridge.predict(self.baseline_rows(history).where(F.col("day") == F.lit(day)))
        if self.trees_model is None:
            return baseline.select(*self.keys, "day", clip(F.col("baseline"), lower=0.0).alias("forecast"))
        rows = self._features(history).where(F.col("day") == F.lit(day)).join(baseline, [*self.keys, "day"])
        aligned = align_columns(rows, [*self.keys, "day", "baseline", *self.columns]).na.fill(0.0, subset=self.columns)
        scored = self.trees_model.transform(assemble(aligned, self.columns))
        return scored.select(*self.keys, "day", clip(F.col("baseline") + F.col("prediction"), lower=0.0).alias("forecast"))


def driver_forecast(panel: DataFrame, keys: Sequence[str], driver: str, horizon: int, lags: int = 14, alpha: float = 10.0, trees: int = 0) -> DataFrame:
    """Keys, day and the driver's own recursive forecast for the horizon, from its lags and the calendar."""
    own = panel.select(*keys, "day", F.col(driver).cast("double").alias(driver), F.lit(0.0).alias("_none"))
    model = WholeForecast(keys, driver, "_none", lags, alpha, trees).fit(own)
    days = F.explode(F.sequence(F.lit(model.last + dt.timedelta(1)), F.lit(model.last + dt.timedelta(horizon))))
    ahead = own.select(*keys).distinct().withColumn("day", days).withColumn("_none", F.lit(0.0))
    return recursive_forecast(model, own, ahead, horizon).withColumnRenamed("forecast", driver)


def recursive_forecast(model: HybridForecast, panel: DataFrame, future: DataFrame, horizon: int) -> DataFrame:
    """Predict day by day, feeding each forecast back as history; returns h rows per series.

    Every day is one distributed job over all series. Only the last days that the
    lags and exposure windows can reach are kept, and the history is written to
    shared storage each step, so the lineage stays short and a lost executor
    costs one day's work. ``future`` holds keys, day and the promotion flag for
    the horizon, so exposure windows and start flags run across the border, and
    the driver's forecast where the model has a driver.
    """
    keys, value, promo = model.keys, model.value, model.promo
    driver = getattr(model, "driver", None)
    reach = getattr(model, "reach", max(model.lags, 2) + 1)
    base = ["day", value, promo, *([driver] if driver else [])]
    recent = panel.where(F.col("day") > F.lit(model.last - dt.timedelta(reach))).select(*keys, *base)
    plan = future.select(*keys, "day", F.lit(None).cast("double").alias(value), promo, *([driver] if driver else []))
    history = materialize(recent.unionByName(plan), "horizon")
    out = None
    for h in range(1, horizon + 1):
        day = model.last + dt.timedelta(h)
        step = materialize(model.predict_day(history, day), "horizon-day")
        out = step if out is None else out.unionByName(step)
        filled = history.join(step, [*keys, "day"], "left").withColumn(value, F.coalesce(value, "forecast")).select(*keys, *base)
        history = materialize(filled.where(F.col("day") > F.lit(day - dt.timedelta(reach))), "horizon")
    return out
