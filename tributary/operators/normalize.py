"""Landed API items to message columns.

Absent and null fields both take the default; `from_json` cannot tell them apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.numbers import to_count
from tributary.functions.text import (
    default_count,
    default_object,
    default_tags,
    default_text,
    default_true,
    text_prefix,
)
from tributary.functions.times import iso_duration_seconds


def normalize_story(items: DataFrame, *carry: str, text_length: int | None = None) -> DataFrame:
    """Texts stay whole unless `text_length` cuts them."""
    return items.select(
        *carry,
        "id",
        default_text("title").alias("title"),
        "type",
        default_text("by").alias("by"),
        default_count("score").alias("score"),
        default_count("descendants").alias("descendants"),
        default_count("time").alias("time"),
        default_text("url").alias("url"),
        text_prefix("text", text_length).alias("text"),
    )


def normalize_event(events: DataFrame, *carry: str) -> DataFrame:
    actor = F.struct(
        F.col("actor.id").alias("id"),
        default_text("actor.display_login").alias("login"),
    )
    return events.select(
        *carry,
        "id",
        "type",
        actor.alias("actor"),
        default_text("repo.name").alias("repo"),
        default_text("created_at").alias("created_at"),
        default_object("payload").alias("payload"),
        default_true("public").alias("public"),
    )


def normalize_video(items: DataFrame, *carry: str, text_length: int | None = None) -> DataFrame:
    """Descriptions stay whole unless `text_length` cuts them."""
    return items.select(
        *carry,
        F.col("id").alias("video_id"),
        default_text("snippet.title").alias("title"),
        default_text("snippet.channelTitle").alias("channel"),
        default_text("snippet.channelId").alias("channel_id"),
        default_text("snippet.publishedAt").alias("published_at"),
        text_prefix("snippet.description", text_length).alias("description"),
        default_tags("snippet.tags").alias("tags"),
        default_text("snippet.categoryId").alias("category_id"),
        to_count("statistics.viewCount").alias("view_count"),
        to_count("statistics.likeCount").alias("like_count"),
        to_count("statistics.commentCount").alias("comment_count"),
        iso_duration_seconds("contentDetails.duration").alias("duration_seconds"),
    )
