"""Names, queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def keep(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = Query(name, build, sql)
        return build

    return keep
