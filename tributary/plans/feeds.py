"""Landed feeds: explode, normalise, repeats, cursors, history, limits, whole runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary import folders
from tributary.functions.numbers import REQUEST_CEILING, clamp_request
from tributary.functions.text import TEXT_LENGTH, matched_queries
from tributary.operators import feeds, normalize, state
from tributary.plans import inputs
from tributary.plans.registry import register
from tributary.sources import landed
from tributary.sources.tables import table

# Page limits, history size, and rows of a popular and of a search list.
MAX_PAGES = 10
ROWS_PER_PAGE = 100
HISTORY_SIZE = 1000
POPULAR_SIZE = 50
SEARCH_SIZE = 10

IN_POLL = inputs.EVENTS_PER_PAGE * inputs.PAGES_PER_POLL
EVENT_PAGES_SQL = f"""
    placed AS (
        SELECT event_id // {IN_POLL} AS poll,
               (event_id % {IN_POLL}) // {inputs.EVENTS_PER_PAGE} + 1 + shift AS page, events.*
        FROM events, (VALUES (0), (1)) s(shift)
        WHERE shift = 0 OR event_type = 'view'
    ), paged AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY poll, page ORDER BY event_id) - 1 AS INTEGER) AS pos
        FROM placed
    )"""
EVENT_FIELDS_SQL = f"""
    CAST(event_id AS VARCHAR) AS id, {inputs.EVENT_TYPE_SQL} AS type, user_id AS actor_id,
    CASE WHEN event_type = 'error' THEN '' ELSE 'user' || user_id END AS actor_login,
    'user' || user_id || '/' || event_type AS repo,
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS created_at,
    CASE WHEN event_type = 'error' THEN '{{}}' ELSE '{{"k":' || (props->>'$.k') || '}}' END AS payload,
    event_type <> 'signup' AS public"""
PUBLISHED_SQL = "event_type IN ('click', 'view', 'purchase')"

TITLE_SQL = "CASE WHEN lang = 'de' THEN '' ELSE split_part(text, chr(10), 1) END"
STORY_FIELDS_SQL = f"""
    doc_id AS id, {TITLE_SQL} AS title, {inputs.STORY_TYPE_SQL} AS type, source AS by,
    CASE WHEN lang = 'es' THEN 0 ELSE n_chars END AS score, CAST(0 AS BIGINT) AS descendants,
    {inputs.FIRST_EPOCH} + (doc_id % {inputs.TIME_SPAN}) * 3600 AS time, '' AS url, text"""
CUT_STORY_FIELDS_SQL = STORY_FIELDS_SQL.removesuffix("text") + "substr(text, 1, 500) AS text"
STORY_LISTS_SQL = f"""
    listed AS (
        SELECT doc_id // {inputs.IDS_PER_LIST} AS poll, 0 AS list_rank,
               CAST(row_number() OVER (PARTITION BY doc_id // {inputs.IDS_PER_LIST}
                                       ORDER BY doc_id) - 1 AS INTEGER) AS pos,
               doc_id AS id FROM documents WHERE lang IN ('en', 'fr')
        UNION ALL
        SELECT doc_id // {inputs.IDS_PER_LIST}, 1,
               CAST(row_number() OVER (PARTITION BY doc_id // {inputs.IDS_PER_LIST}
                                       ORDER BY doc_id DESC) - 1 AS INTEGER),
               doc_id FROM documents
    )"""

SECURE = "url LIKE 'https%'"
HOST_SQL = "regexp_extract(url, '://([^/]+)/', 1)"
PUBLISHED_AT_SQL = (
    f"strftime(TIMESTAMP '2024-01-01' + to_minutes(CAST((page_id % {inputs.TIME_SPAN}) * 13 AS INTEGER)), "
    "'%Y-%m-%dT%H:%M:%SZ')"
)
VIDEO_FIELDS_SQL = f"""
    'v' || page_id AS video_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
    {HOST_SQL} AS channel, CASE WHEN {SECURE} THEN md5({HOST_SQL}) ELSE '' END AS channel_id,
    {PUBLISHED_AT_SQL} AS published_at, html AS description,
    CASE WHEN contains(url, '?') THEN ''
         ELSE array_to_string(string_split(regexp_extract(url, '://[^/]+/([^?#]*)', 1), '/'), ',') END AS tags,
    '' AS category_id, CAST(length(html) AS BIGINT) * 1000000 AS view_count,
    CASE WHEN {SECURE} THEN length(url) ELSE 0 END AS like_count,
    CASE WHEN {SECURE} THEN 0 ELSE page_id END AS comment_count,
    CASE WHEN {SECURE} THEN (page_id % 3) * 3600 + (page_id % 60) * 60 ELSE 0 END AS duration_seconds"""

CUT_VIDEO_FIELDS_SQL = VIDEO_FIELDS_SQL.replace("html AS description", "substr(html, 1, 500) AS description")


def flat_event(messages: DataFrame, *carry: str) -> DataFrame:
    return messages.select(
        *carry,
        "id",
        "type",
        F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login"),
        "repo",
        "created_at",
        "payload",
        "public",
    )


def flat_video(messages: DataFrame, *carry: str) -> DataFrame:
    """The tag list as text; the check compares plain values."""
    return messages.withColumn("tags", F.array_join("tags", ",")).select(*carry, *VIDEO_COLUMNS)


VIDEO_COLUMNS = [
    "video_id", "title", "channel", "channel_id", "published_at", "description", "tags",
    "category_id", "view_count", "like_count", "comment_count", "duration_seconds",
]


def event_pages(spark: SparkSession, folder: str) -> DataFrame:
    responses = inputs.event_responses(table(spark, folder, "events"))
    return landed.event_pages(responses, "poll", "page")


def video_details(spark: SparkSession, folder: str) -> DataFrame:
    return landed.video_envelopes(inputs.video_responses(table(spark, folder, "pages")), "envelope")


# --- landed responses -------------------------------------------------------


@register("story_list_explode", f"WITH {STORY_LISTS_SQL} SELECT * FROM listed")
def story_list_explode(spark: SparkSession, folder: str) -> DataFrame:
    responses = inputs.story_list_responses(table(spark, folder, "documents"))
    return landed.story_lists(responses, "poll", "list_rank")


@register(
    "paged_feed_explode",
    f"WITH {EVENT_PAGES_SQL} SELECT poll, page, pos, CAST(event_id AS VARCHAR) AS id, "
    f"{inputs.EVENT_TYPE_SQL} AS type FROM paged",
)
def paged_feed_explode(spark: SparkSession, folder: str) -> DataFrame:
    return event_pages(spark, folder).select("poll", "page", "pos", "id", "type")


@register(
    "search_result_lookup",
    f"SELECT {CUT_VIDEO_FIELDS_SQL} FROM pages WHERE NOT {SECURE}",
)
def search_result_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Search responses name videos; their details come from the envelopes."""
    pages = table(spark, folder, "pages")
    found = pages.where(~F.startswith(F.col("url"), F.lit("https"))).select(
        F.expr(f"page_id DIV {inputs.VIDEOS_PER_ENVELOPE}").alias("envelope"),
        F.struct(
            F.struct(F.concat(F.lit("v"), F.col("page_id")).alias("videoId")).alias("id")
        ).alias("item"),
    )
    items = F.sort_array(F.collect_list("item"))
    responses = found.groupBy("envelope").agg(F.to_json(F.struct(items.alias("items"))).alias("raw_json"))
    ids = landed.search_results(responses).select(F.col("video_id").alias("id"))
    details = normalize.normalize_video(video_details(spark, folder), text_length=TEXT_LENGTH)
    return flat_video(feeds.look_up(ids, details.withColumn("id", F.col("video_id")), "id"))


# --- normalise --------------------------------------------------------------


@register("normalize_story", f"SELECT {CUT_STORY_FIELDS_SQL} FROM documents WHERE doc_id % 97 <> 0")
def normalize_story(spark: SparkSession, folder: str) -> DataFrame:
    responses = inputs.story_item_responses(table(spark, folder, "documents"))
    return normalize.normalize_story(landed.story_items(responses), text_length=TEXT_LENGTH)


@register(
    "normalize_event",
    f"WITH {EVENT_PAGES_SQL} SELECT poll, page, pos, {EVENT_FIELDS_SQL} FROM paged",
)
def normalize_event(spark: SparkSession, folder: str) -> DataFrame:
    messages = normalize.normalize_event(event_pages(spark, folder), "poll", "page", "pos")
    return flat_event(messages, "poll", "page", "pos")


@register("normalize_video", f"SELECT {CUT_VIDEO_FIELDS_SQL} FROM pages")
def normalize_video(spark: SparkSession, folder: str) -> DataFrame:
    return flat_video(normalize.normalize_video(video_details(spark, folder), text_length=TEXT_LENGTH))


# --- filters and cursors ----------------------------------------------------


@register(
    "type_equals",
    "SELECT event_id, user_id, event_type AS type FROM events WHERE event_type = 'purchase'",
)
def type_equals(spark: SparkSession, folder: str) -> DataFrame:
    """The type is a stored column, so the scan itself gets the filter."""
    typed = table(spark, folder, "events").select("event_id", "user_id", F.col("event_type").alias("type"))
    return feeds.of_type(typed, "purchase")


@register(
    "type_in_set",
    f"SELECT event_id, user_id, event_type AS type FROM events WHERE {PUBLISHED_SQL}",
)
def type_in_set(spark: SparkSession, folder: str) -> DataFrame:
    typed = table(spark, folder, "events").select("event_id", "user_id", F.col("event_type").alias("type"))
    return feeds.published_types(typed, ("click", "view", "purchase"))


@register(
    "high_water_mark",
    "SELECT event_id, user_id FROM events WHERE event_id > "
    "(SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-15')",
)
def high_water_mark(spark: SparkSession, folder: str) -> DataFrame:
    """What was published before a day sets the mark."""
    events = table(spark, folder, "events").select("event_id", "user_id", "ts")
    earlier = events.where("ts < timestamp_ntz'2024-01-15 00:00:00'")
    mark = feeds.highest_id(earlier, "event_id")
    return feeds.above_mark(events, "event_id", mark).drop("ts")


@register(
    "highest_id_per_source",
    "SELECT event_type, max(event_id) AS mark FROM events GROUP BY event_type",
)
def highest_id_per_source(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.highest_ids(table(spark, folder, "events"), "event_type", "event_id")


@register(
    "equality_cursor",
    "SELECT event_id, user_id FROM events WHERE CAST(event_id AS VARCHAR) <> '57'",
)
def equality_cursor(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        "event_id", "user_id", F.col("event_id").cast("string").alias("id")
    )
    return feeds.not_last(events, "id", "57").drop("id")


@register(
    "not_in_history",
    "SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS "
    "(SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal < 0)",
)
def not_in_history(spark: SparkSession, folder: str) -> DataFrame:
    seen = table(spark, folder, "customer").where("c_acctbal < 0")
    history = seen.select(F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return feeds.not_in_history(orders, history, "o_custkey").select("o_orderkey", "o_custkey")


@register(
    "allowed_set_semi",
    "SELECT doc_id, lang, source FROM documents WHERE doc_id IN "
    "(SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0)",
)
def allowed_set_semi(spark: SparkSession, folder: str) -> DataFrame:
    allowed = table(spark, folder, "labels").where("quality = 1 AND toxic = 0")
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source")
    return feeds.in_allowed_set(documents, allowed, "doc_id")


@register(
    "ids_to_items",
    "WITH ids AS (SELECT l_orderkey AS id, l_shipdate, l_linenumber, l_partkey, l_suppkey, "
    "row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, "
    "l_suppkey) AS nth FROM lineitem) SELECT id, strftime(l_shipdate, '%Y-%m-%d') AS first_shipped, "
    "CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, o_custkey, o_totalprice "
    "FROM ids JOIN orders ON id = o_orderkey WHERE nth = 1",
)
def ids_to_items(spark: SparkSession, folder: str) -> DataFrame:
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id"), *order)
    items = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), "o_custkey", "o_totalprice"
    )
    return feeds.look_up(feeds.first_seen(lines, ["id"], order), items, "id").select(
        "id",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("first_shipped"),
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        "l_partkey",
        "o_custkey",
        "o_totalprice",
    )


SEARCHES = ["worthless", "the tion", "benchmark", "license"]


@register(
    "keyword_search",
    "SELECT doc_id, query_rank, query FROM documents, (VALUES "
    + ", ".join(f"({i}, '{q}')" for i, q in enumerate(SEARCHES))
    + ") q(query_rank, query) WHERE contains(lower(text), query) OR contains(lower(source), query)",
)
def keyword_search(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "source")
    hits = feeds.search(documents, ["text", "source"], SEARCHES)
    return hits.select("doc_id", "query_rank", "query")


# --- repeats ----------------------------------------------------------------


@register(
    "union_feeds_first_wins",
    "WITH feed AS (SELECT 0 AS list_rank, * FROM events WHERE event_type = 'purchase' "
    "UNION ALL SELECT 1, * FROM events), ranked AS (SELECT *, row_number() OVER "
    "(PARTITION BY user_id ORDER BY list_rank, event_id) AS nth FROM feed) "
    "SELECT user_id, list_rank, event_id, event_type, value FROM ranked WHERE nth = 1",
)
def union_feeds_first_wins(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", "value")
    feed = feeds.union_feeds([events.where("event_type = 'purchase'"), events])
    return feeds.first_seen(feed, ["user_id"], ["list_rank", "event_id"])


@register("distinct_in_run", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_in_run(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.distinct_keys(table(spark, folder, "events"), ["user_id", "event_type"])


# --- limits -----------------------------------------------------------------


@register(
    "limit_in_feed_order",
    "WITH feed AS (SELECT 0 AS list_rank, event_id, user_id FROM events "
    "WHERE event_type = 'error' UNION ALL SELECT 1, event_id, user_id FROM events "
    "WHERE event_type <> 'error') SELECT * FROM feed ORDER BY list_rank, event_id LIMIT 25",
)
def limit_in_feed_order(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    parts = [
        events.where(test).select("event_id", "user_id")
        for test in ("event_type = 'error'", "event_type <> 'error'")
    ]
    return feeds.take(feeds.union_feeds(parts), ["list_rank", "event_id"], 25)


LONG_POLL = 1500


@register(
    "page_cap",
    f"SELECT event_id // {LONG_POLL} AS poll, (event_id % {LONG_POLL}) // 100 + 1 AS page, "
    f"event_id % 100 AS pos, event_id FROM events WHERE (event_id % {LONG_POLL}) // 100 + 1 <= 10",
)
def page_cap(spark: SparkSession, folder: str) -> DataFrame:
    """Polls of fifteen pages, of which the API serves ten."""
    placed = table(spark, folder, "events").select(
        F.expr(f"event_id DIV {LONG_POLL}").alias("poll"),
        F.expr(f"(event_id % {LONG_POLL}) DIV 100 + 1").alias("page"),
        F.expr("event_id % 100").alias("pos"),
        "event_id",
    )
    return feeds.cap_pages(placed, MAX_PAGES, ROWS_PER_PAGE)


@register(
    "newest_n",
    "SELECT event_id, user_id, epoch_us(ts) AS ts_us FROM events ORDER BY ts DESC, event_id LIMIT 50",
)
def newest_n(spark: SparkSession, folder: str) -> DataFrame:
    """Asks for a hundred; the API's ceiling is fifty."""
    events = table(spark, folder, "events").select("event_id", "user_id", "ts")
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    return feeds.newest(events, "ts", "event_id", clamp_request(100, REQUEST_CEILING)).select("event_id", "user_id", micros.alias("ts_us"))


@register(
    "most_popular",
    "SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 50",
)
def most_popular(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "value")
    return feeds.most_popular(events, "value", "event_id", 50)


# --- history ----------------------------------------------------------------

NEWEST_SEEN_SQL = """
    merged AS (SELECT l_returnflag AS source, CAST(l_orderkey AS VARCHAR) AS key,
                      max(l_shipdate) AS seen_at FROM lineitem GROUP BY ALL),
    kept AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY seen_at DESC, key) AS nth
             FROM merged)"""


def seen_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order keys seen per return flag: earlier runs and the latest one, merged and bounded."""
    sightings = table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("source"),
        F.col("l_orderkey").cast("string").alias("key"),
        F.col("l_shipdate").alias("seen_at"),
    )
    day = "timestamp_ntz'1998-01-01 00:00:00'"
    earlier = sightings.where(f"seen_at < {day}")
    latest = sightings.where(f"seen_at >= {day}")
    merged = feeds.merge_history(earlier, latest)
    return feeds.bounded_history(merged, HISTORY_SIZE)


@register(
    "history_merge_bounded",
    f"WITH {NEWEST_SEEN_SQL} SELECT source, key, strftime(seen_at, '%Y-%m-%d') AS seen_on "
    "FROM kept WHERE nth <= 1000",
)
def history_merge_bounded(spark: SparkSession, folder: str) -> DataFrame:
    kept = seen_orders(spark, folder)
    return kept.select("source", "key", F.date_format("seen_at", "yyyy-MM-dd").alias("seen_on"))


@register(
    "seen_state_roundtrip",
    f"WITH {NEWEST_SEEN_SQL} SELECT o_orderkey, o_custkey FROM orders WHERE CAST(o_orderkey AS VARCHAR) "
    "NOT IN (SELECT key FROM kept WHERE nth <= 1000 AND source = 'R')",
)
def seen_state_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """One run stores its state, the next reads it and skips what it names."""
    root = folders.work_folder(spark, "state")
    kept = seen_orders(spark, folder)
    state.save_history(kept.withColumn("seen_at", F.col("seen_at").cast("timestamp")), root)
    history = state.read_history(spark, root).where("source = 'R'")
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderkey").cast("string").alias("key")
    )
    return feeds.not_in_history(orders, history, "key").select("o_orderkey", "o_custkey")


# --- whole runs -------------------------------------------------------------


@register(
    "story_feed_run",
    f"WITH {STORY_LISTS_SQL}, "
    "firsts AS (SELECT id, poll, list_rank, pos FROM (SELECT *, row_number() OVER "
    "(PARTITION BY id ORDER BY poll, list_rank, pos) AS nth FROM listed) WHERE nth = 1) "
    f"SELECT poll, list_rank, pos, {STORY_FIELDS_SQL} FROM firsts "
    "JOIN documents ON firsts.id = doc_id WHERE doc_id % 97 <> 0 AND lang IN ('en', 'fr') "
    "AND doc_id > (SELECT max(item_id) FROM benchmark)",
)
def story_feed_run(spark: SparkSession, folder: str) -> DataFrame:
    """Two ranked lists per poll, items looked up; ids up to the mark are published already."""
    documents = table(spark, folder, "documents")
    lists = landed.story_lists(inputs.story_list_responses(documents), "poll", "list_rank")
    items = landed.story_items(inputs.story_item_responses(documents))
    mark = feeds.highest_id(table(spark, folder, "benchmark"), "item_id")
    return feeds.story_feed(lists, items, ["poll", "list_rank", "pos"], mark=mark)


@register(
    "event_feed_run",
    f"WITH {EVENT_PAGES_SQL}, firsts AS (SELECT * FROM (SELECT *, row_number() OVER "
    "(PARTITION BY event_id ORDER BY poll, page, pos) AS nth FROM paged) WHERE nth = 1) "
    f"SELECT poll, page, pos, {EVENT_FIELDS_SQL} FROM firsts WHERE {PUBLISHED_SQL} "
    "AND ts >= TIMESTAMP '2024-01-03' AND event_id <> 9000",
)
def event_feed_run(spark: SparkSession, folder: str) -> DataFrame:
    """Overlapping pages; what came before a day is in the history, and one id is the last."""
    events = table(spark, folder, "events")
    earlier = events.where("ts < timestamp_ntz'2024-01-03 00:00:00'")
    history = earlier.select(F.col("event_id").cast("string").alias("key"))
    order = ["poll", "page", "pos"]
    messages = feeds.event_feed(event_pages(spark, folder), order, history=history, last="9000")
    return flat_event(messages, *order)


VIDEO_SEARCHES = ["script", "class=", "license"]


@register(
    "video_feed_run",
    f"WITH video AS (SELECT page_id, 'v' || page_id AS id, html, length(html) AS views, "
    f"regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, {PUBLISHED_AT_SQL} AS published "
    "FROM pages), popular AS (SELECT 0 AS list_rank, row_number() OVER "
    "(ORDER BY views DESC, id) - 1 AS pos, page_id, id FROM video), "
    "hits AS (SELECT query_rank + 1 AS list_rank, row_number() OVER (PARTITION BY query_rank "
    "ORDER BY published DESC, id) - 1 AS pos, page_id, id FROM video, (VALUES "
    + ", ".join(f"({i}, '{q}')" for i, q in enumerate(VIDEO_SEARCHES))
    + ") q(query_rank, query) WHERE contains(lower(title), query) OR contains(lower(html), query)), "
    "feed AS (SELECT * FROM popular WHERE pos < 50 UNION ALL SELECT * FROM hits WHERE pos < 10), "
    "firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY list_rank, pos) "
    "AS nth FROM feed) WHERE nth = 1) "
    f"SELECT list_rank, CAST(pos AS INTEGER) AS pos, {CUT_VIDEO_FIELDS_SQL} FROM firsts JOIN pages USING (page_id) "
    "WHERE page_id NOT IN (SELECT item_id FROM benchmark)",
)
def video_feed_run(spark: SparkSession, folder: str) -> DataFrame:
    """The fifty most viewed, then the ten newest of each search, less the history.

    One pass over the envelopes parses them, searches the whole texts and stores the
    messages with the searches they match; what ranks and looks up reads only those.
    """
    columns = ["snippet.title", "snippet.description"]
    details = video_details(spark, folder)
    searched = details.withColumn("found_by", matched_queries(columns, VIDEO_SEARCHES))
    stored = f"{folders.work_folder(spark, 'videos')}/messages"
    normalize.normalize_video(searched, "found_by", text_length=TEXT_LENGTH).write.parquet(stored)
    videos = spark.read.parquet(stored).withColumn("id", F.col("video_id"))

    most_viewed = feeds.most_popular(
        videos.select("id", "view_count"), "view_count", "id", POPULAR_SIZE
    )
    popular = positions(most_viewed, [], [F.desc("view_count"), "id"]).withColumn("list_rank", F.lit(0))
    newest_first = [F.desc("published_at"), "id"]
    found = videos.select("id", "published_at", F.explode("found_by").alias("query_rank"))
    newest = feeds.top_per_group(found, ["query_rank"], newest_first, SEARCH_SIZE, ["id"])
    hits = positions(newest, ["query_rank"], newest_first).withColumn(
        "list_rank", F.col("query_rank") + 1
    )
    published = table(spark, folder, "benchmark")
    history = published.select(F.concat(F.lit("v"), F.col("item_id")).alias("key"))
    messages = feeds.video_feed(popular, hits, videos.drop("found_by"), history=history)
    return flat_video(messages, "list_rank", "pos")


def positions(frame: DataFrame, group: list[str], order: list) -> DataFrame:
    """Number the rows of short ranked lists from 0."""
    window = Window.partitionBy(*group).orderBy(*order)
    return frame.withColumn("pos", F.row_number().over(window) - 1)


# --- runs that follow each other, and what cannot be read -------------------


@register(
    "story_feed_two_runs",
    f"WITH {STORY_LISTS_SQL}, ids AS (SELECT DISTINCT id FROM listed) "
    f"SELECT {STORY_FIELDS_SQL} FROM ids JOIN documents ON id = doc_id "
    "WHERE doc_id % 97 <> 0 AND lang IN ('en', 'fr')",
)
def story_feed_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    """A run with a limit, then one without: every id is sent exactly once, though each item was fetched twice."""
    documents = table(spark, folder, "documents")
    lists = landed.story_lists(inputs.story_list_responses(documents), "poll", "list_rank")
    item = landed.story_items(inputs.story_item_responses(documents)).withColumn("line", F.lit(1))
    earlier = item.withColumn("title", F.lit("earlier")).withColumn("line", F.lit(0))
    items = feeds.newest_items(earlier.unionByName(item), "id", "line")
    order, root = ["poll", "list_rank", "pos"], folders.work_folder(spark, "state")
    sent = folders.work_folder(spark, "sent")
    for limit in (40, None):
        run = feeds.story_feed(lists, items, order, history=state.read_history(spark, root), limit=limit)
        path = f"{sent}/run={limit or 0}"
        run.drop(*order).write.parquet(path)
        seen = feeds.seen_now(spark.read.parquet(path), "hackernews", "id", F.current_timestamp())
        state.append_history(seen, root)
    return spark.read.parquet(f"{sent}/run=40", f"{sent}/run=0")


@register(
    "event_feed_all_pages",
    f"SELECT event_id // {LONG_POLL} AS poll, (event_id % {LONG_POLL}) // 100 + 1 AS page, "
    f"CAST(event_id % 100 AS INTEGER) AS pos, {EVENT_FIELDS_SQL} FROM events WHERE {PUBLISHED_SQL}",
)
def event_feed_all_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Polls of fifteen pages, of which nothing is left out unless a caller says so."""
    items = inputs.event_items(table(spark, folder, "events"))
    order = ["poll", "page", "pos"]
    placed = items.select(
        F.expr(f"event_id DIV {LONG_POLL}").alias("poll"),
        F.expr(f"(event_id % {LONG_POLL}) DIV 100 + 1").alias("page"),
        F.expr("CAST(event_id % 100 AS INT)").alias("pos"),
        "item.*",
    )
    placed = placed.withColumn("payload", F.to_json("payload"))
    return flat_event(feeds.event_feed(placed, order), *order)


@register(
    "landed_quarantine",
    "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'malformed' WHEN doc_id % 5 = 1 THEN 'unexpected shape' "
    "ELSE 'good' END AS side FROM documents",
)
def landed_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Item lines cut short, lines of another shape, `null` answers and good ones; none vanishes."""
    documents = table(spark, folder, "documents").select("doc_id", F.struct(F.col("doc_id").alias("id"), "text").alias("item"))
    line = F.to_json("item")
    kind = F.col("doc_id") % 5
    broken = (
        F.when(kind == 0, F.substring(line, 1, 8))
        .when(kind == 1, F.concat(F.lit("["), line, F.lit("]")))
        .when(kind == 2, F.lit("null"))
        .otherwise(line)
    )
    good, bad = landed.split_lines(documents.select("doc_id", broken.alias("raw_json")), "story_item")
    return good.select("doc_id", F.lit("good").alias("side")).union(bad.select("doc_id", "reason"))


ELEMENT_SIDES_SQL = (
    "CASE WHEN envelope % 7 = 3 THEN 'error response' WHEN page_id % 11 = 0 THEN 'null element' "
    "WHEN page_id % 11 = 1 THEN 'unexpected shape' WHEN page_id % 11 = 2 THEN 'missing key' "
    "WHEN page_id % 11 = 3 THEN 'misfit' ELSE 'good' END"
)


@register(
    "landed_elements_quarantine",
    f"WITH placed AS (SELECT page_id, page_id // {inputs.VIDEOS_PER_ENVELOPE} AS envelope, row_number() OVER "
    f"(PARTITION BY page_id // {inputs.VIDEOS_PER_ENVELOPE} ORDER BY page_id) - 1 AS place FROM pages) "
    f"SELECT DISTINCT envelope, CASE WHEN envelope % 7 <> 3 THEN CAST(place AS INTEGER) END AS pos, {ELEMENT_SIDES_SQL} AS side, "
    f"CASE WHEN {ELEMENT_SIDES_SQL} = 'good' THEN 'v' || page_id END AS id FROM placed",
)
def landed_elements_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Envelopes where some videos are null, numbers, without an id or of another shape, and some that tell of an error:
    good and bad elements are all the elements."""
    videos = inputs.video_items(table(spark, folder, "pages"))
    kind = F.col("page_id") % 11
    text = (
        F.when(kind == 0, "null")
        .when(kind == 1, "7")
        .when(kind == 2, '{"snippet": {"title": "t"}}')
        .when(kind == 3, '{"id": "v", "snippet": [1]}')
        .otherwise(F.to_json("item"))
    )
    envelope = F.expr(f"page_id DIV {inputs.VIDEOS_PER_ENVELOPE}").alias("envelope")
    texts = F.transform(F.sort_array(F.collect_list(F.struct("page_id", text.alias("text")))), lambda e: e["text"])
    response = F.concat(F.lit('{"items":['), F.array_join(texts, ","), F.lit("]}"))
    responses = videos.groupBy(envelope).agg(response.alias("raw_json"))
    failed = F.lit('{"error": {"code": 403, "message": "quota"}}')
    responses = responses.withColumn("raw_json", F.when(F.col("envelope") % 7 == 3, failed).otherwise(F.col("raw_json")))
    judged = landed.elements(responses, "video_envelope", "envelope")
    good = landed.good_elements(judged, "envelope", "pos").select("envelope", "pos", F.lit("good").alias("side"), "id")
    bad = landed.bad_elements(judged, "video_envelope", "envelope")
    return good.union(bad.select("envelope", "pos", "reason", F.lit(None).cast("string")))
