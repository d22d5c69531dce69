"""All DuckDB oracle SQL, keyed like the query registry."""

from __future__ import annotations


def all_oracles() -> dict[str, str]:
    from tessera.plans import geo_oracle, geometry_queries, learn_queries, raster_queries, table_queries
    out: dict[str, str] = {}
    for mod in (geo_oracle, geometry_queries, learn_queries, raster_queries, table_queries):
        out.update(mod.oracles())
    return out
