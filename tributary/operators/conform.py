"""Bronze to typed silver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tributary import schemas
from tributary.functions.times import epoch_to_timestamp, iso_to_timestamp, utc_date
from tributary.operators.feeds import first_seen


def conform_story(bronze: DataFrame) -> DataFrame:
    posted_at = epoch_to_timestamp("time")
    return bronze.select(
        "id",
        "title",
        "type",
        "score",
        "time",
        "by",
        "descendants",
        "url",
        "text",
        posted_at.alias("posted_at"),
        utc_date(posted_at).alias("event_date"),
        "source",
        "ingested_at",
    )


def conform_event(bronze: DataFrame) -> DataFrame:
    created_at = iso_to_timestamp("created_at")
    return bronze.select(
        "id",
        "type",
        created_at.alias("created_at"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo").alias("repo_name"),
        F.col("actor.id").alias("actor_id"),
        "payload",
        F.col("public").try_cast("boolean").alias("public"),
        utc_date(created_at).alias("event_date"),
        "source",
        "ingested_at",
    )


def conform_video(bronze: DataFrame) -> DataFrame:
    published_at = iso_to_timestamp("published_at")
    return bronze.select(
        "video_id",
        "title",
        "view_count",
        "like_count",
        published_at.alias("published_at"),
        F.col("channel").alias("channel_title"),
        "channel_id",
        "description",
        "tags",
        "category_id",
        "comment_count",
        "duration_seconds",
        utc_date(published_at).alias("event_date"),
        "source",
        "ingested_at",
    )


CONFORM: dict[str, Callable[[DataFrame], DataFrame]] = {
    "hackernews": conform_story,
    "github": conform_event,
    "youtube": conform_video,
}


def replaced(silver: DataFrame, fresh: DataFrame, source: str) -> DataFrame:
    """The stored rows whose key has a newer copy in `fresh`."""
    key = schemas.source(source).key
    return silver.join(fresh.select(key), key, "left_semi")


def silver_update(silver: DataFrame, fresh: DataFrame, source: str) -> DataFrame:
    """Stored rows after `fresh`, the silver rows of later batches: a newer copy of a key replaces the stored one.

    The stored ones are kept by an anti join, which the planner turns into a broadcast of the new keys
    while they measure small.
    """
    key = schemas.source(source).key
    return silver.join(fresh.select(key), key, "left_anti").select(*fresh.columns).unionByName(fresh)


def silver_schema(spark: SparkSession, source: str) -> StructType:
    """What silver rows of a source look like, with or without a row."""
    columns = f"{schemas.source(source).message}, source STRING, ingested_at TIMESTAMP"
    return silver_rows(spark.createDataFrame([], columns), source).schema


def silver_rows(bronze: DataFrame, source: str, *newest_first: str) -> DataFrame:
    """One row per key: delivery is at least once, so bronze may hold repeats.

    `newest_first` names the columns that order the copies, the first deciding; by
    default the time of ingestion, then the record's offset and time, where kept: copies of a
    key stand in one partition, and a batch has one time of ingestion.
    Copies equal in all of these are told apart by a hash of their message, so that
    a lost task that runs again picks the same one.
    """
    spec = schemas.source(source)
    stored = [c for c in ("ingested_at", "offset", "timestamp") if c in bronze.columns]
    order = [F.col(c).desc_nulls_last() for c in (newest_first or stored)]
    message = F.xxhash64(*spec.schema.names)
    return CONFORM[spec.name](first_seen(bronze, [spec.key], [*order, message]))
