"""Compositions of the operators: registered queries and the staged workflow."""

from __future__ import annotations

import importlib

from sensorlens.plans.catalog import ORACLES, QUERIES, Query

MODULES = ("reading", "understanding", "preparing", "modelling", "neighbouring", "timing", "ruling")


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"sensorlens.plans.{name}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
