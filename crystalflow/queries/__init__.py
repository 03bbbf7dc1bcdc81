"""Registered queries: every operator run over the supplied tables.

The tables know nothing of crystals, so :mod:`crystalflow.queries.roles` lets
them play the parts of materials, tasks, frames, formulas and listings. Each
query is registered with the SQL that must give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}

_MODULES = ["selecting", "framing", "chemistry", "reading", "syncing", "exporting", "checking", "curating"]


def query(sql: str | None = None):
    """Register a function ``(tables) -> DataFrame`` under its own name."""

    def register(fn: Callable[[Tables], DataFrame]):
        REGISTRY[fn.__name__] = Query(fn.__name__, lambda spark, sf: fn(Tables(spark, sf)), sql)
        return fn

    return register


class Tables:
    """Lazy access to the Parquet tables of one folder: ``tables.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def load() -> dict[str, Query]:
    for module in _MODULES:
        import_module(f"crystalflow.queries.{module}")
    return REGISTRY
