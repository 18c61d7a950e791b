"""Named queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class NamedQuery:
    name: str
    build: Builder
    sql: str | None


_QUERIES: dict[str, NamedQuery] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a builder; ``sql`` states the same result over the raw tables."""

    def register(build: Builder) -> Builder:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = NamedQuery(name, build, sql)
        return build

    return register


def all_queries() -> dict[str, NamedQuery]:
    return dict(_QUERIES)
