"""JSON definitions: topic catalogues, rule suites and checkpoints.

These documents are written by people and hold a few dozen lines, so reading
one into the driver is bounded by the document, not by the data.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.rules import Rule, Suite

TOPIC_SETTINGS = (
    "MAP<STRING, STRUCT<partitions: INT, retention_ms: BIGINT, "
    "cleanup_policy: STRING, description: STRING>>"
)
CATALOGUE = f"topics {TOPIC_SETTINGS}, common_config MAP<STRING, BIGINT>"
SUITE = (
    "expectation_suite_name STRING, expectations ARRAY<STRUCT<expectation_type: STRING, "
    "kwargs: MAP<STRING, STRING>>>"
)
CHECKPOINT = (
    "name STRING, run_name_template STRING, validations ARRAY<STRUCT<"
    "batch_request: STRUCT<data_asset_name: STRING>, expectation_suite_name: STRING>>"
)


def topic_catalogue(documents: DataFrame) -> DataFrame:
    """Catalogue documents (already parsed) to one row per topic."""
    return documents.select(
        F.explode("topics").alias("topic", "settings"),
        "common_config",
    ).select("topic", "settings.*", "common_config")


def read_topic_catalogue(spark: SparkSession, path: str) -> DataFrame:
    return topic_catalogue(spark.read.schema(CATALOGUE).json(path, multiLine=True))


def rule_rows(spark: SparkSession, path: str) -> DataFrame:
    """Suite documents to (suite, idx, type, kwargs); an unnamed suite takes its file's name."""
    from_file = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1)
    documents = spark.read.schema(SUITE).json(path, multiLine=True)
    return documents.select(
        F.coalesce("expectation_suite_name", from_file).alias("suite"),
        F.posexplode("expectations").alias("idx", "rule"),
    ).select(
        "suite",
        "idx",
        F.col("rule.expectation_type").alias("type"),
        F.col("rule.kwargs").alias("kwargs"),
    )


ARGUMENTS = {"column", "min_value", "max_value", "value_set", "type_"}


def bound(text: str | None) -> int | float | str | None:
    """A bound as written: a whole number, another number, or text such as a date."""
    if text is None or text == "null":
        return None
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            continue
    return text


def rule_of(kind: str, arguments: dict[str, str]) -> Rule:
    """A rule from its JSON arguments; one that is not understood is an error, never left out."""
    unknown = {k for k, v in arguments.items() if v is not None} - ARGUMENTS
    if unknown:
        raise ValueError(f"{kind} has arguments that are not understood: {sorted(unknown)}")
    allowed = arguments.get("value_set")
    return Rule(
        kind,
        arguments["column"],
        low=bound(arguments.get("min_value")),
        high=bound(arguments.get("max_value")),
        allowed=tuple(json.loads(allowed)) if allowed is not None else None,
        family=arguments.get("type_"),
    )


def read_suites(spark: SparkSession, path: str) -> dict[str, Suite]:
    rules: dict[str, list[Rule]] = {}
    for row in rule_rows(spark, path).orderBy("suite", "idx").collect():
        rules.setdefault(row["suite"], []).append(rule_of(row["type"], row["kwargs"] or {}))
    return {name: Suite(name, tuple(found)) for name, found in rules.items()}


def validation_rows(spark: SparkSession, path: str) -> DataFrame:
    """Checkpoint document to (checkpoint, run_name_template, idx, asset, suite)."""
    documents = spark.read.schema(CHECKPOINT).json(path, multiLine=True)
    return documents.select(
        F.col("name").alias("checkpoint"),
        "run_name_template",
        F.posexplode("validations").alias("idx", "validation"),
    ).select(
        "checkpoint",
        "run_name_template",
        "idx",
        F.col("validation.batch_request.data_asset_name").alias("asset"),
        F.col("validation.expectation_suite_name").alias("suite"),
    )


def read_validations(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(asset, suite) pairs in document order."""
    rows = validation_rows(spark, path).orderBy("idx").collect()
    return [(r["asset"], r["suite"]) for r in rows]


def read_run_name(spark: SparkSession, path: str, moment: datetime) -> str:
    """The checkpoint's run-name template at a moment."""
    template = validation_rows(spark, path).select("run_name_template").first().run_name_template
    if template is None:
        raise ValueError(f"{path} has no run_name_template")
    return moment.strftime(template)
