"""Audits of what has landed, as rows."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary import folders, schemas
from tributary.sources import bronze


def topic_message_count(records: DataFrame) -> DataFrame:
    """Messages per topic as the sum of end offsets over its partitions."""
    ends = records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    return ends.groupBy("topic").agg(
        F.count("*").alias("n_partitions"), F.sum("end_offset").alias("n_messages")
    )


def topic_audit(records: DataFrame, topics: list[str]) -> DataFrame:
    """Every expected topic with its messages; a topic without any fails."""
    expected = F.explode(F.array(*[F.lit(t) for t in topics]))
    wanted = records.sparkSession.range(1).select(expected.alias("topic"))
    named = records.where(F.col("topic").isin(*topics))
    counted = wanted.join(topic_message_count(named), "topic", "left")
    messages = F.coalesce("n_messages", F.lit(0).cast("bigint"))
    return counted.select("topic", messages.alias("n_messages"), (messages > 0).alias("success"))


def landed(frame: DataFrame, source: str, required: list[str], files: DataFrame) -> DataFrame:
    """One row about a bronze leaf: files, good rows, quarantined rows and required columns.

    `files` is the commit log: it also has the files without rows, and no list of files goes through the driver.
    """
    missing = [c for c in required if c not in frame.columns]
    listed = files.select("file_name")
    counted = bronze.committed_files(frame)
    name = F.substring_index("file_path", "/", -1).alias("file_name")
    files = listed.join(counted.select(name, "n_rows", "n_quarantined"), "file_name", "left")
    return files.agg(
        F.count("*").alias("n_files"),
        F.coalesce(F.sum("n_rows"), F.lit(0).cast("bigint")).alias("n_rows"),
        F.coalesce(F.sum("n_quarantined"), F.lit(0).cast("bigint")).alias("n_quarantined"),
    ).select(
        F.lit(source).alias("source"),
        "n_files",
        "n_rows",
        "n_quarantined",
        F.lit(",".join(missing)).alias("missing_columns"),
        (F.col("n_files") > 0).alias("has_files"),
        (F.col("n_rows") > 0).alias("has_rows"),
        F.lit(not missing).alias("has_columns"),
    )


def landing_audit(
    spark: SparkSession, root: str, required: dict[str, list[str]], merge_schema: bool = False
) -> DataFrame:
    """One row per source in `required`; a source that never landed fails every check.

    The columns are those of the files, not the declared ones: of one file, or of
    all of them with `merge_schema`.
    """
    parts = []
    for source, columns in required.items():
        frame = _leaf_or_none(spark, bronze.leaf_path(root, source), merge_schema)
        parts.append(
            _never_landed(spark, source, columns)
            if frame is None
            else landed(frame, source, columns, bronze.commit_log(spark, bronze.leaf_path(root, source)))
        )
    return reduce(DataFrame.unionByName, parts)


def _leaf_or_none(spark: SparkSession, path: str, merge_schema: bool) -> DataFrame | None:
    """The leaf, None if there is no folder or no committed file in it to take columns from."""
    if not folders.exists(spark, path):
        return None
    try:
        return bronze.read_leaf(spark, path, merge_schema)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def _never_landed(spark: SparkSession, source: str, required: list[str]) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return spark.range(1).select(
        F.lit(schemas.source(source).name).alias("source"),
        zero.alias("n_files"),
        zero.alias("n_rows"),
        zero.alias("n_quarantined"),
        F.lit(",".join(required)).alias("missing_columns"),
        F.lit(False).alias("has_files"),
        F.lit(False).alias("has_rows"),
        F.lit(False).alias("has_columns"),
    )


def landing_checks(audit: DataFrame) -> DataFrame:
    """Audit columns to (source, check, success) rows."""
    checks = F.array(
        *[
            F.struct(F.lit(c).alias("check"), F.col(c).alias("success"))
            for c in ("has_files", "has_rows", "has_columns")
        ]
    )
    return audit.select("source", F.inline(checks))


def catalogue_audit(declared: DataFrame, found: DataFrame, settings: list[str]) -> DataFrame:
    """Two topic catalogues side by side; a topic agrees if both hold it with equal settings."""
    pairs = declared.select("topic", F.struct(*settings).alias("declared")).join(
        found.select("topic", F.struct(*settings).alias("found")), "topic", "full_outer"
    )
    both = F.col("declared").isNotNull() & F.col("found").isNotNull()
    return pairs.select(
        "topic",
        *[F.col(f"{side}.{s}").alias(f"{side}_{s}") for side in ("declared", "found") for s in settings],
        (both & F.col("declared").eqNullSafe(F.col("found"))).alias("success"),
    )
