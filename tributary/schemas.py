"""Declared schemas and the source registry.

Every column is nullable. Counts and numeric ids are BIGINT so that a large
value is kept rather than turned into null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

CORRUPT = "_corrupt"

# Topic names, source names and message fields.
STORY_MESSAGE = (
    "id BIGINT, title STRING, type STRING, by STRING, score BIGINT, "
    "descendants BIGINT, time BIGINT, url STRING, text STRING"
)
EVENT_MESSAGE = (
    "id STRING, type STRING, actor STRUCT<id: BIGINT, login: STRING>, repo STRING, "
    "created_at STRING, payload STRING, public STRING"
)
VIDEO_MESSAGE = (
    "video_id STRING, title STRING, channel STRING, channel_id STRING, "
    "published_at STRING, description STRING, tags ARRAY<STRING>, category_id STRING, "
    "view_count BIGINT, like_count BIGINT, comment_count BIGINT, duration_seconds BIGINT"
)

# Landed API payloads. Statistics arrive as text and are declared as such: an
# integer field would turn "12" into null.
STORY_LIST = "ARRAY<BIGINT>"
STORY_ITEM = STORY_MESSAGE
EVENT_ITEM = (
    "id: STRING, type: STRING, actor: STRUCT<id: BIGINT, display_login: STRING>, "
    "repo: STRUCT<name: STRING>, created_at: STRING, payload: STRING, public: BOOLEAN"
)
EVENT_PAGE = f"ARRAY<STRUCT<{EVENT_ITEM}>>"
VIDEO_ITEM = (
    "id: STRING, "
    "snippet: STRUCT<title: STRING, channelTitle: STRING, channelId: STRING, publishedAt: STRING, "
    "description: STRING, tags: ARRAY<STRING>, categoryId: STRING>, "
    "statistics: STRUCT<viewCount: STRING, likeCount: STRING, commentCount: STRING>, "
    "contentDetails: STRUCT<duration: STRING>"
)
VIDEO_ENVELOPE = f"items ARRAY<STRUCT<{VIDEO_ITEM}>>"
SEARCH_ITEM = "id: STRUCT<videoId: STRING>"
SEARCH_ENVELOPE = f"items ARRAY<STRUCT<{SEARCH_ITEM}>>"

KAFKA_RECORD = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, "
    "timestamp TIMESTAMP, timestampType INT"
)
HISTORY = "source STRING, key STRING, seen_at TIMESTAMP"

TYPE_FAMILIES: dict[str, tuple[type[T.DataType], ...]] = {
    "INTEGER": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "FLOAT": (T.FloatType, T.DoubleType),
    "STRING": (T.StringType,),
    "BOOLEAN": (T.BooleanType,),
    "DATE": (T.DateType,),
    "TIMESTAMP": (T.TimestampType, T.TimestampNTZType),
}


@dataclass(frozen=True)
class Source:
    """One feed: where it arrives, how a message looks and what identifies it."""

    name: str
    topic: str
    key: str
    message: str
    raw_json_field: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.message)


SOURCES: dict[str, Source] = {
    s.name: s
    for s in (
        Source("hackernews", "hackernews-posts", "id", STORY_MESSAGE),
        Source("github", "github-events", "id", EVENT_MESSAGE, raw_json_field="payload"),
        Source("youtube", "youtube-videos", "video_id", VIDEO_MESSAGE),
    )
}


def source(name: str) -> Source:
    """Look a source up by name; an unknown name is an error, never a default."""
    try:
        return SOURCES[name]
    except KeyError:
        raise ValueError(f"unknown source {name!r}; known: {sorted(SOURCES)}") from None


def topic_routes() -> dict[str, str]:
    return {s.topic: s.name for s in SOURCES.values()}
