"""Names, queries and SQL of this subpackage."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tributary.llm.common import ship

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def keep(build: Build) -> Build:
        @functools.wraps(build)
        def shipped(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return build(spark, folder)

        QUERIES[name] = shipped
        if sql:
            ORACLE[name] = sql
        return build

    return keep
