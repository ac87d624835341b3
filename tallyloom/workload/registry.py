"""Registry of named queries."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune
from .inputs import Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
MODULES = ["io", "metadata", "validation", "cleaning", "responses", "derive", "weights", "codelists", "configured", "editions"]


def query(name: str, sql: str | None = None):
    """Register ``fn(inputs) -> DataFrame`` under a name, with the SQL that must give the same rows."""
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(tune(spark), sf_dir))
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def load_all() -> None:
    for module in MODULES:
        importlib.import_module(f"{__package__}.q_{module}")
