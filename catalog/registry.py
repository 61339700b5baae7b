"""Registration of queries and their oracles."""

from __future__ import annotations

from catalog.views import with_ctes

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: list[str] | None = None):
    """Register a ``(spark, folder) -> DataFrame`` function under its key."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_ctes(ctes or [], sql)
        return fn

    return register
