"""Registry that pairs Spark plans with oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def plan(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under ``name``, with oracle SQL where SQL can express it."""

    def register(fn: Plan) -> Plan:
        if name in PLANS:
            raise ValueError(f"duplicate plan {name}")
        PLANS[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(c: Column | str, digits: int = 4) -> Column:
    """Rounded double without negative zero, for comparison across engines."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), digits) + F.lit(0.0)


def day_text(c: Column | str) -> Column:
    """A day as ISO text, which every engine renders alike."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd")
