"""The given tables seen as feeds.

Stories come from `documents`, repository events from `events`, videos from
`pages`. Each function derives the landed form of a whole table, with some fields
left out or unreadable so that defaults and quarantine have work to do. Landed
responses hold as many items as an API page does; the page is part of the grouping
key, so packing never makes a large group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.normalize import normalize_event, normalize_story, normalize_video
from tributary.operators.parse import bronze_rows
from tributary.operators.publish import to_kafka_records
from tributary.sources import kafka
from tributary.sources.tables import table

EVENT_TYPE_NAMES = {
    "click": "PushEvent",
    "view": "WatchEvent",
    "purchase": "ReleaseEvent",
    "signup": "CreateEvent",
    "error": "GollumEvent",
}
EVENT_TYPE_SQL = (
    "CASE event_type WHEN 'click' THEN 'PushEvent' WHEN 'view' THEN 'WatchEvent' "
    "WHEN 'purchase' THEN 'ReleaseEvent' WHEN 'signup' THEN 'CreateEvent' ELSE 'GollumEvent' END"
)
STORY_TYPES = {"en": "story", "fr": "story", "es": "comment", "de": "job"}
STORY_TYPE_SQL = "CASE lang WHEN 'es' THEN 'comment' WHEN 'de' THEN 'job' ELSE 'story' END"
FIRST_EPOCH = 1704067200
TIME_SPAN = 1000000  # derived times start over here, so that they stay valid dates in any table
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"

IDS_PER_LIST = 500
EVENTS_PER_PAGE = 50
PAGES_PER_POLL = 9
VIDEOS_PER_ENVELOPE = 50


def lookup(names: dict[str, str], column: str) -> Column:
    entries = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.try_element_at(entries, F.col(column))


# --- repository events ------------------------------------------------------


def event_items(events: DataFrame) -> DataFrame:
    """(event_id, item): an error event lacks login, payload and public."""
    failed = F.col("event_type") == "error"
    user = F.concat(F.lit("user"), F.col("user_id"))
    item = F.struct(
        F.col("event_id").cast("string").alias("id"),
        lookup(EVENT_TYPE_NAMES, "event_type").alias("type"),
        F.struct(
            F.col("user_id").alias("id"), F.when(~failed, user).alias("display_login")
        ).alias("actor"),
        F.struct(F.concat(user, F.lit("/"), F.col("event_type")).alias("name")).alias("repo"),
        F.date_format("ts", ISO_SECONDS).alias("created_at"),
        F.when(~failed, F.from_json("props", "k BIGINT")).alias("payload"),
        F.when(~failed, F.col("event_type") != "signup").alias("public"),
    )
    return events.select("event_id", "event_type", item.alias("item"))


def event_responses(events: DataFrame) -> DataFrame:
    """(poll, page, raw_json): pages of a poll, where a view shows up again on the next page."""
    poll_size = EVENTS_PER_PAGE * PAGES_PER_POLL
    page = F.expr(f"(event_id % {poll_size}) DIV {EVENTS_PER_PAGE} + 1")
    again = F.when(F.col("event_type") == "view", F.array(page, page + 1)).otherwise(F.array(page))
    placed = event_items(events).select(
        F.expr(f"event_id DIV {poll_size}").alias("poll"),
        F.explode(again).alias("page"),
        F.struct("event_id", "item").alias("entry"),
    )
    entries = F.sort_array(F.collect_list("entry"))
    response = F.to_json(F.transform(entries, lambda e: e["item"]))
    return placed.groupBy("poll", "page").agg(response.alias("raw_json"))


def event_messages(events: DataFrame) -> DataFrame:
    items = event_items(events).select("event_id", "item.*")
    return normalize_event(items.withColumn("payload", F.to_json("payload")), "event_id")


def event_records(events: DataFrame) -> DataFrame:
    """Kafka-shaped records of the event messages; batch or stream."""
    return kafka.records(
        to_kafka_records(event_messages(events), "github", "event_id"),
        "key",
        F.col("value"),
        F.col("topic"),
        F.col("event_id") % 3,
        F.expr("event_id DIV 3"),
    )


# --- stories ----------------------------------------------------------------


def story_list_responses(documents: DataFrame) -> DataFrame:
    """(poll, list_rank, raw_json): the top list holds two languages, the new list all, newest first."""
    poll = F.expr(f"doc_id DIV {IDS_PER_LIST}").alias("poll")
    top = (
        documents.where(F.col("lang").isin("en", "fr"))
        .groupBy(poll)
        .agg(F.to_json(F.sort_array(F.collect_list("doc_id"))).alias("raw_json"))
        .withColumn("list_rank", F.lit(0))
    )
    new = (
        documents.groupBy(poll)
        .agg(F.to_json(F.sort_array(F.collect_list("doc_id"), asc=False)).alias("raw_json"))
        .withColumn("list_rank", F.lit(1))
    )
    return top.unionByName(new)


def story_columns(documents: DataFrame) -> DataFrame:
    """Item fields: German items have no title, Spanish ones no score, none has a url."""
    return documents.select(
        F.col("doc_id").alias("id"),
        F.when(F.col("lang") != "de", F.substring_index("text", "\n", 1)).alias("title"),
        lookup(STORY_TYPES, "lang").alias("type"),
        F.col("source").alias("by"),
        F.when(F.col("lang") != "es", F.col("n_chars")).alias("score"),
        F.lit(None).cast("bigint").alias("descendants"),
        (F.lit(FIRST_EPOCH) + F.col("doc_id") % TIME_SPAN * 3600).alias("time"),
        F.lit(None).cast("string").alias("url"),
        "text",
    )


def story_item_responses(documents: DataFrame) -> DataFrame:
    """(raw_json): one response per item; the fetch of every 97th gave `null`."""
    items = story_columns(documents)
    response = F.when(F.col("id") % 97 != 0, F.to_json(F.struct(*items.columns)))
    return items.select(F.coalesce(response, F.lit("null")).alias("raw_json"))


def story_messages(documents: DataFrame) -> DataFrame:
    return normalize_story(story_columns(documents))


# --- videos -----------------------------------------------------------------


def video_items(pages: DataFrame) -> DataFrame:
    """(page_id, item): some videos lack tags or a channel id, some counts are not numbers."""
    published = F.expr(
        "timestamp_ntz'2024-01-01 00:00:00' + "
        f"make_dt_interval(0, 0, CAST(page_id % {TIME_SPAN} AS INT) * 13)"
    )
    secure = F.startswith(F.col("url"), F.lit("https"))
    path = F.regexp_extract("url", r"://[^/]+/([^?#]*)", 1)
    snippet = F.struct(
        F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"),
        F.regexp_extract("url", r"://([^/]+)/", 1).alias("channelTitle"),
        F.when(secure, F.md5(F.regexp_extract("url", r"://([^/]+)/", 1))).alias("channelId"),
        F.date_format(published, ISO_SECONDS).alias("publishedAt"),
        F.col("html").alias("description"),
        F.when(~F.contains(F.col("url"), F.lit("?")), F.split(path, "/")).alias("tags"),
        F.lit(None).cast("string").alias("categoryId"),
    )
    statistics = F.struct(
        (F.length("html").cast("bigint") * 1000000).cast("string").alias("viewCount"),
        F.when(secure, F.length("url").cast("string")).alias("likeCount"),
        F.when(secure, F.lit("n/a")).otherwise(F.col("page_id").cast("string")).alias("commentCount"),
    )
    duration = F.concat(
        F.lit("PT"), F.col("page_id") % 3, F.lit("H"), F.col("page_id") % 60, F.lit("M")
    )
    item = F.struct(
        F.concat(F.lit("v"), F.col("page_id")).alias("id"),
        snippet.alias("snippet"),
        statistics.alias("statistics"),
        F.struct(F.when(secure, duration).alias("duration")).alias("contentDetails"),
    )
    return pages.select("page_id", item.alias("item"))


def video_responses(pages: DataFrame) -> DataFrame:
    """(envelope, raw_json): `{"items": [...]}` of at most 50 videos."""
    envelope = F.expr(f"page_id DIV {VIDEOS_PER_ENVELOPE}").alias("envelope")
    entries = F.sort_array(F.collect_list(F.struct("page_id", "item")))
    items = F.transform(entries, lambda e: e["item"])
    response = F.to_json(F.struct(items.alias("items")))
    return video_items(pages).groupBy(envelope).agg(response.alias("raw_json"))


def video_messages(pages: DataFrame) -> DataFrame:
    return normalize_video(video_items(pages).select("item.*"))


# --- bronze -----------------------------------------------------------------


def records_of(messages: DataFrame, source: str) -> DataFrame:
    """Messages as Kafka-shaped records, without a position in the log."""
    sent = to_kafka_records(messages, source)
    return kafka.records(sent, "key", F.col("value"), F.col("topic"), F.lit(0), F.lit(0))


MESSAGES = {
    "hackernews": ("documents", story_messages),
    "github": ("events", event_messages),
    "youtube": ("pages", video_messages),
}


def bronze_of(spark: SparkSession, folder: str, source: str) -> DataFrame:
    """A source's bronze rows in batch, through the same parse as the stream."""
    name, messages = MESSAGES[source]
    records = records_of(messages(table(spark, folder, name)), source)
    return bronze_rows(kafka.raw_json(records), source)
