"""Registered keys: one Spark query and (where SQL can express it) one DuckDB

Each key is a callable ``(spark, sf_dir) -> DataFrame`` that reads the whole
driver tables of ``sf_dir`` through the fixture mapping.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

_MODULES = ("sources", "models", "quality", "reports", "churn", "primitives")


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate key {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    for m in _MODULES:
        try:
            importlib.import_module(f"{__name__}.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"{__name__}.{m}":
                raise
