"""Imports every plan module once and hands out the registry."""

from __future__ import annotations

import importlib

from panelwright.plans.registry import ORACLES, PLANS

MODULES = ("scans", "expressions", "text", "aggregates", "windows", "joins", "reshape", "splits", "timeseries", "features", "evaluation", "models", "streams")


def load() -> tuple[dict, dict]:
    for m in MODULES:
        importlib.import_module(f"panelwright.plans.{m}")
    return dict(PLANS), dict(ORACLES)
