"""All registered queries of the evidence operators and their SQL."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import plans

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with DuckDB SQL for the same rows."""

    def add(f):
        if f.__name__ in QUERIES:
            raise ValueError(f"{f.__name__} is registered twice")
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _load() -> None:
    for m in sorted(x.name for x in pkgutil.iter_modules(plans.__path__)):
        importlib.import_module(f"{plans.__name__}.{m}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
