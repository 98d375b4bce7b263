"""Query registry: key -> (Spark plan builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    oracle: str | None
    survey_ids: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, *, oracle: str | None, ids: tuple[str, ...] = ()):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query key {name}")
        REGISTRY[name] = Query(name, fn, oracle, ids)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    from rankdelta.plans import queries  # noqa: F401  (registers on import)
    return REGISTRY
