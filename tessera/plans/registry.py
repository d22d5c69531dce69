"""Query registry: name -> Spark callable (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_KIND: dict[str, str] = {}      # "S" (DuckDB SQL oracle) or "R" (rows + pytest)
FLAGSHIP: list[str] = []


def register(name: str, oracle: str = "S", flagship: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        ORACLE_KIND[name] = oracle
        if flagship:
            FLAGSHIP.append(name)
        return fn
    return deco


def load_all() -> dict[str, QueryFn]:
    """Import every query module so the registry is complete."""
    from tessera.plans import geo_queries, geometry_queries, learn_queries, raster_queries, table_queries  # noqa: F401
    return QUERIES
