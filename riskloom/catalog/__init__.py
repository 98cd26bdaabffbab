"""Registered queries over the driver tables, each with its SQL check where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = oracle
        return query

    return keep


def load_all() -> None:
    from riskloom.catalog import (  # noqa: F401
        evaluation,
        exploration,
        features,
        modelling,
        preparation,
        resampling,
    )
