"""Time-series diagnostics as tables, for every series of a daily panel at once.

Inputs are dense daily panels; a series has at most one row per calendar day.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelwright.functions.calendar import resample_key
from panelwright.operators import panel as P
from panelwright.operators.reshape import keep_one


def guarded_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are known; NULL for a constant side."""
    both = x.isNotNull() & y.isNotNull()
    sx, sy = F.stddev_pop(F.when(both, x)), F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(F.when(both, x), F.when(both, y)), sx * sy)


def seasonal_profile(panel: DataFrame, value: str, period: Column, position: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Mean value per (period, position), e.g. per ISO week and weekday."""
    return panel.groupBy(*keys, period.alias("period"), position.alias("position")).agg(F.avg(value).alias("mean"))


def periodogram(panel: DataFrame, keys: Sequence[str], value: str, day: str = "day", detrend: str = "linear",
                samples_per_year: float = 365.0) -> DataFrame:
    """One-sided power spectrum (boxcar window, spectrum scaling) per series.

    One FFT per series over its calendar days: n log n instead of a row per
    (day, frequency). The panel must not hold NULLs.
    """
    keys = list(keys)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in panel.select(*keys).schema.fields)

    def spectrum(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(day)[value].to_numpy(dtype=float)
        n = len(x)
        if detrend == "linear" and n > 1:
            t = np.arange(n, dtype=float) - (n - 1) / 2
            x = x - x.mean() - t * (t @ x) / (t @ t)
        elif detrend in ("linear", "constant"):
            x = x - x.mean()
        power = np.abs(np.fft.rfft(x)) ** 2 / n**2
        power[1:(n + 1) // 2] *= 2  # every bin but zero and, for even n, the last has a mirror image
        out = pd.DataFrame({"frequency": np.arange(len(power)) * samples_per_year / n, "power": power})
        for c in reversed(keys):
            out.insert(0, c, pdf[c].iloc[0])
        return out

    return panel.select(*keys, day, value).groupBy(*keys).applyInPandas(
        spectrum, f"{schema}, frequency double, power double")


def lag_correlations(panel: DataFrame, keys: Sequence[str], x: str, y: str, lags: Sequence[int], day: str = "day",
                     out: str = "corr") -> DataFrame:
    """corr(y_t, x_{t-k}) per series and lag k; negative lags look ahead."""
    w = P.series_window(keys, day)
    shifted = panel.select(*keys, F.col(y).alias("_y"), *[F.lag(x, k).over(w).alias(f"_x{i}") for i, k in enumerate(lags)])
    long = shifted.select(*keys, "_y", F.explode(F.array(*[
        F.struct(F.lit(int(k)).alias("lag"), F.col(f"_x{i}").alias("x")) for i, k in enumerate(lags)])).alias("_s"))
    both = F.col("_s.x").isNotNull() & F.col("_y").isNotNull()
    return long.groupBy(*keys, "_s.lag").agg(guarded_corr(F.col("_s.x"), F.col("_y")).alias(out), F.count_if(both).alias("n_pairs"))


def best_lags(correlations: DataFrame, keys: Sequence[str], corr: str = "corr") -> DataFrame:
    """Per series the lag with the largest absolute correlation; the earliest lag wins ties."""
    known = correlations.where(F.col(corr).isNotNull())
    return keep_one(known, keys, [-F.abs(corr), F.col("lag")], ["lag", corr])


def autocovariances(panel: DataFrame, keys: Sequence[str], value: str, lags: int, day: str = "day") -> DataFrame:
    """Array of autocovariances 0..lags per series (full-sample mean, divisor n)."""
    known = panel.where(F.col(value).isNotNull())
    centred = known.withColumn("_x", F.col(value) - F.avg(value).over(Window.partitionBy(*keys)))
    w = P.series_window(keys, day)
    shifted = centred.select(*keys, "_x", *[F.lag("_x", k).over(w).alias(f"_l{k}") for k in range(1, lags + 1)])
    sums = [F.sum(F.col("_x") * (F.col("_x") if k == 0 else F.col(f"_l{k}"))) / F.count(F.lit(1)) for k in range(lags + 1)]
    return shifted.groupBy(*keys).agg(F.array(*[F.coalesce(s, F.lit(0.0)) for s in sums]).alias("acov"),
                                      F.count(F.lit(1)).alias("n"))


def partial_autocorrelations(panel: DataFrame, keys: Sequence[str], value: str, lags: int, day: str = "day") -> DataFrame:
    """PACF 1..lags per series: Yule-Walker by the Durbin-Levinson recursion on the autocovariances."""
    acov = autocovariances(panel, keys, value, lags, day)
    pacf = F.pandas_udf(_durbin_levinson, "array<double>")
    return acov.select(*keys, "n", F.posexplode(pacf("acov")).alias("lag", "pacf")).select(
        *keys, (F.col("lag") + 1).alias("lag"), F.nanvl("pacf", F.lit(None).cast("double")).alias("pacf"), "n")


def _durbin_levinson(acov: pd.Series) -> pd.Series:
    def one(r) -> list[float]:
        r = np.asarray(r, dtype=float)
        phi, out, err = np.zeros(0), [], r[0]
        for k in range(1, len(r)):
            if not err > 0:
                out.append(float("nan"))
                continue
            last = (r[k] - phi @ r[k - 1:0:-1]) / err if k > 1 else r[1] / r[0]
            phi = np.append(phi - last * phi[::-1], last)
            err *= 1 - last * last
            out.append(float(last))
        return out

    return acov.map(one)


def cross_correlations(aligned: DataFrame, keys: Sequence[str], time: str, x: str, y: str, lags: int) -> DataFrame:
    """CCF of every series: mean of (x_{t+k} - mx)(y_t - my) / (sx sy) over the full length, for k in -lags..lags.

    ``aligned`` has one row per series and period, so the calendar bounds each
    window. A constant side gives NULL.
    """
    rows = aligned.select(*keys, time, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).na.drop(subset=["_x", "_y"])
    w, whole = Window.partitionBy(*keys).orderBy(time), Window.partitionBy(*keys)
    z = rows.select(
        *keys, time,
        F.try_divide(F.col("_x") - F.avg("_x").over(whole), F.stddev_pop("_x").over(whole)).alias("_x"),
        F.try_divide(F.col("_y") - F.avg("_y").over(whole), F.stddev_pop("_y").over(whole)).alias("_y"))
    names = [f"_p{i}" for i in range(2 * lags + 1)]
    products = z.select(*keys, *[(F.lead("_x", k).over(w) * F.col("_y")).alias(n) for n, k in zip(names, range(-lags, lags + 1))])
    sums = products.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in names])
    return sums.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(k).alias("lag"), (F.col(n) / F.col("_n")).alias("ccf"), F.col("_n").alias("n"))
        for n, k in zip(names, range(-lags, lags + 1))])).alias("r")).select(*keys, "r.*")


def cross_correlation(aligned: DataFrame, time: str, x: str, y: str, lags: int) -> DataFrame:
    """CCF of one aligned pair, one row per period."""
    return cross_correlations(aligned.withColumn("_k", F.lit(0)), ["_k"], time, x, y, lags).drop("_k")


def driver_ccf(driver: DataFrame, price: str, cycle: DataFrame, level: str, lags: int, rule: str | None = "W-SUN",
               returns: bool = True, day: str = "day") -> DataFrame:
    """CCF between a driver (log returns or level) and a global cycle, both daily filled and resampled."""
    def daily(df: DataFrame, value: str) -> DataFrame:
        dense = P.dense_daily(df.select(day, value, F.lit(0).alias("_k")), ["_k"], day)
        return dense.select("_k", day, P.forward_fill(value, ["_k"], day).alias(value))

    d, c = daily(driver, price), daily(cycle, level)
    x = P.log_return("_pos", ["_k"], day) if returns else F.col(price)
    d = d.withColumn("_pos", F.when(F.col(price) != 0, F.col(price)))
    d = d.withColumn("_pos", P.forward_fill("_pos", ["_k"], day)).withColumn("_x", x)
    key = resample_key(F.col(day), rule or "D").alias("_t")
    xs = d.groupBy(key).agg(F.avg("_x").alias("_x"))
    ys = c.groupBy(key).agg(F.percentile(level, 0.5).alias("_y"))  # at most a quarter of daily values per group
    return cross_correlation(xs.join(ys, "_t"), "_t", "_x", "_y", lags)


def lag_summary(panel: DataFrame, keys: Sequence[str], residual: str, signal: str, lags: int, day: str = "day") -> DataFrame:
    """Per series the best lag in -lags..lags between a residual and the log1p return of a signal.

    Both are carried forward on the daily grid first; ``n`` aligned rows give the
    95 % band 1.96 / sqrt(n).
    """
    filled = panel.select(*keys, day, P.forward_fill(residual, keys, day).alias("_res"),
                          P.forward_fill(signal, keys, day).alias("_sig"))
    aligned = filled.withColumn("_ret", P.log_return("_sig", keys, day, plus_one=True)).na.drop(subset=["_res", "_ret"])
    best = best_lags(lag_correlations(aligned, keys, "_ret", "_res", range(-lags, lags + 1), day), keys)
    sizes = aligned.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return best.join(sizes, list(keys)).select(*keys, F.col("lag").alias("best_lag"), "corr", "n",
                                               (F.lit(1.96) / F.sqrt("n")).alias("ci95"))


def demean(panel: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*keys)
    return panel.withColumns({c: F.col(c) - F.avg(c).over(w) for c in columns})


def fit_ar(panel: DataFrame, keys: Sequence[str], value: str, max_order: int = 7, day: str = "day") -> DataFrame:
    """AR coefficients without trend per series; the order 1..max_order with the lowest AIC.

    Spark computes the lag cross-products of every candidate order; workers solve
    systems of at most ``max_order`` unknowns. A series that no order fits gets an empty array.
    """
    w = P.series_window(keys, day)
    known = panel.where(F.col(value).isNotNull()).select(*keys, day, F.col(value).alias("_l0"))
    lagged = known.select(*keys, "_l0", *[F.lag("_l0", k).over(w).alias(f"_l{k}") for k in range(1, max_order + 1)])
    sums = []
    for p in range(1, max_order + 1):
        ready = F.col(f"_l{p}").isNotNull()
        sums.append(F.count_if(ready).cast("double"))
        sums += [F.sum(F.when(ready, F.col(f"_l{i}") * F.col(f"_l{j}"))) for i in range(p + 1) for j in range(i, p + 1)]
    moments = lagged.groupBy(*keys).agg(F.array(*[F.coalesce(s, F.lit(0.0)) for s in sums]).alias("_m"))

    def solve(m: pd.Series) -> pd.Series:
        return m.map(lambda v: _best_ar(np.asarray(v, dtype=float), max_order))

    return moments.select(*keys, F.pandas_udf(solve, "array<double>")("_m").alias("phi"))


def _best_ar(m: np.ndarray, max_order: int) -> list[float]:
    best, pos = (np.inf, []), 0
    for p in range(1, max_order + 1):
        n, size = m[pos], (p + 1) * (p + 2) // 2
        cross = np.zeros((p + 1, p + 1))
        cross[np.triu_indices(p + 1)] = m[pos + 1:pos + 1 + size]
        cross = cross + np.triu(cross, 1).T
        pos += 1 + size
        if n <= p:
            continue
        try:
            phi = np.linalg.solve(cross[1:, 1:], cross[1:, 0])
        except np.linalg.LinAlgError:
            continue
        sigma2 = (cross[0, 0] - phi @ cross[1:, 0]) / n
        if not sigma2 > 0:
            continue
        aic = n * (np.log(2 * np.pi) + np.log(sigma2) + 1) + 2 * (p + 1)
        if aic < best[0]:
            best = (aic, [float(v) for v in phi])
    return best[1]


def ar_filter(panel: DataFrame, keys: Sequence[str], columns: Sequence[str], coefficients: DataFrame | Sequence[float],
              day: str = "day", max_order: int = 7) -> DataFrame:
    """Subtract the AR part of each column; the coefficients are a fixed list or a table per series."""
    w = P.series_window(keys, day)
    if isinstance(coefficients, DataFrame):
        rows, order = panel.join(coefficients, list(keys)), max_order
        phi = [F.get(F.col("phi"), F.lit(k)) for k in range(order)]
        # a lag before the series' start leaves NULL, but only up to the fitted order
        terms = {c: [F.when(phi[k].isNull(), F.lit(0.0)).otherwise(phi[k] * F.lag(c, k + 1).over(w)) for k in range(order)]
                 for c in columns}
    else:
        rows, order = panel, len(coefficients)
        terms = {c: [F.lit(float(p)) * F.lag(c, k + 1).over(w) for k, p in enumerate(coefficients)] for c in columns}
    out = {}
    for c in columns:
        x = F.col(c)
        for t in terms[c]:
            x = x - t
        out[c] = x
    return rows.withColumns(out)


def prewhitened_summary(panel: DataFrame, keys: Sequence[str], residual: str, signal: str, max_lead: int = 16,
                        max_order: int = 7, min_points: int = 100, day: str = "day") -> DataFrame:
    """Best lead of a prewhitened signal on a prewhitened residual, per series with enough points."""
    filled = panel.select(*keys, day, P.forward_fill(residual, keys, day).alias("_res"),
                          P.forward_fill(signal, keys, day).alias("_sig"))
    centred = demean(filled, keys, ["_res", "_sig"])
    phis = fit_ar(centred, keys, "_sig", max_order, day)
    white = ar_filter(centred, keys, ["_res", "_sig"], phis, day, max_order).na.drop(subset=["_res", "_sig"])
    sizes = white.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max(F.size("phi")).alias("ar_order")).where(
        F.col("n") >= max(min_points, max_lead + 5))
    best = best_lags(lag_correlations(white, keys, "_sig", "_res", range(max_lead + 1), day), keys)
    return best.join(sizes, list(keys)).select(*keys, F.col("lag").alias("best_lead"), "corr", "n",
                                               (F.lit(1.96) / F.sqrt("n")).alias("ci95"), "ar_order")


def event_study(panel: DataFrame, keys: Sequence[str], value: str, binary: str, before: int = 7, after: int = 14,
                min_gap: int = 7, day: str = "day") -> DataFrame:
    """Mean path of a value around the 0 to 1 starts of a binary signal, over full windows only.

    Starts closer than ``min_gap`` days to the last kept one are skipped. Returns
    (keys, offset, mean, n_events).
    """
    filled = panel.select(*keys, day, P.forward_fill(value, keys, day).alias("_v"),
                          P.forward_fill(binary, keys, day).alias("_b"))
    starts = filled.where(F.col("_b").isNotNull()).select(*keys, day, P.start_flag("_b", keys, day).alias("_s")).where("_s")
    if min_gap > 1:
        starts = P.thin_by_gap(starts, keys, day, min_gap)
    offsets = starts.select(*keys, F.col(day).alias("_start"),
                            F.explode(F.sequence(F.lit(-before), F.lit(after))).alias("offset"))
    path = offsets.withColumn(day, F.date_add("_start", F.col("offset"))).join(
        filled.where(F.col("_v").isNotNull()).select(*keys, day, "_v"), [*keys, day])
    full = path.groupBy(*keys, "_start").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == before + after + 1)
    return path.join(full, [*keys, "_start"], "left_semi").groupBy(*keys, "offset").agg(
        F.avg("_v").alias("mean"), F.count(F.lit(1)).alias("n_events"))
