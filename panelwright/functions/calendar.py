"""Day arithmetic and calendar design columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F


def week_ending_sunday(day: Column) -> Column:
    """The Sunday that closes the week of ``day``."""
    return F.date_add(F.date_trunc("week", day).cast("date"), 6)


def resample_key(day: Column, rule: str) -> Column:
    """Right-labelled period end for the rules W-SUN, M and Q; the day itself for D."""
    if rule in ("W", "W-SUN"):
        return week_ending_sunday(day)
    if rule == "M":
        return F.last_day(day)
    if rule == "Q":
        return F.date_sub(F.add_months(F.date_trunc("quarter", day).cast("date"), 3), 1)
    if rule == "D":
        return day
    raise ValueError(f"unknown resample rule {rule!r}")


def period_phase(day: Column, freq: str) -> Column:
    """Elapsed share of the calendar year (A), quarter (Q) or month (M) at ``day``."""
    unit = {"A": "year", "Q": "quarter", "M": "month"}[freq]
    months = {"A": 12, "Q": 3, "M": 1}[freq]
    start = F.date_trunc(unit, day).cast("date")
    return F.datediff(day, start) / F.datediff(F.add_months(start, months), start)


def fourier(day: Column, freq: str, order: int) -> dict[str, Column]:
    """Sine and cosine columns for the harmonics 1..order of a calendar period."""
    out = {}
    for k in range(1, order + 1):
        angle = period_phase(day, freq) * F.lit(2 * 3.141592653589793 * k)
        out[f"sin_{k}_{freq}"] = F.sin(angle)
        out[f"cos_{k}_{freq}"] = F.cos(angle)
    return out


def trend_terms(day: Column, start: dt.date | Column, order: int) -> dict[str, Column]:
    """Powers 1..order of the day number, counted from 1 on the start day."""
    t = (F.datediff(day, F.lit(start) if isinstance(start, dt.date) else start) + 1).cast("double")
    names = ["trend", "trend_squared", "trend_cubed"]
    return {names[k] if k < 3 else f"trend_{k + 1}": F.pow(t, F.lit(float(k + 1))) if k else t for k in range(order)}


def weekday_dummies(day: Column, start: dt.date | Column, drop_first: bool = False) -> dict[str, Column]:
    """Seven seasonal dummies whose season 1 is the weekday of the start day."""
    pos = F.pmod(F.datediff(day, F.lit(start) if isinstance(start, dt.date) else start), F.lit(7)) + 1
    return {f"s_{k}_7": (pos == k).cast("double") for k in range(2 if drop_first else 1, 8)}


def design_columns(day: Column, start: dt.date | Column, order: int = 2, weekly: bool = False, freq: str = "A",
                   fourier_order: int | None = None, intercept: bool = False) -> dict[str, Column]:
    """Trend, weekly and Fourier regressors; with an intercept the collinear first dummy is left out."""
    cols = trend_terms(day, start, order)
    if weekly:
        cols |= weekday_dummies(day, start, drop_first=intercept)
    if fourier_order:
        cols |= fourier(day, freq, fourier_order)
    return cols


def day_bounds(df: DataFrame, day: str) -> tuple[dt.date, dt.date]:
    """First and last day of a table."""
    return tuple(df.agg(F.min(day), F.max(day)).first())


def day_range(df: DataFrame, day: str = "day", horizon: int = 0) -> DataFrame:
    """Every day between the first and the last one, plus ``horizon`` future days (flag ``is_future``).

    One row per calendar day: the table is bounded by the length of the calendar.
    """
    span = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    days = F.explode(F.sequence("lo", F.date_add("hi", horizon)))
    return span.select(days.alias(day), "hi").select(day, (F.col(day) > F.col("hi")).alias("is_future"))
