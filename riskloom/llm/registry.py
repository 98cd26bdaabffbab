"""The queries of this subpackage and their SQL checks."""

from __future__ import annotations

from riskloom.catalog import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = oracle
        return query

    return keep
