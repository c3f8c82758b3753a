"""Feed logic: order, repeats, cursors, history, limits.

A feed row carries the columns that say where it stood (poll, list_rank, page,
pos). "First" always means first by those columns, with the key last, so every
result is the same however the rows are spread.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.text import matched_queries
from tributary.operators.normalize import normalize_event, normalize_story
from tributary.operators.places import with_places

# Event types that are published, searches.
STORY_TYPE = "story"
EVENT_TYPES = (
    "PushEvent",
    "PullRequestEvent",
    "IssuesEvent",
    "WatchEvent",
    "ForkEvent",
    "IssueCommentEvent",
    "PullRequestReviewEvent",
    "ReleaseEvent",
)
SEARCH_QUERIES = ("technology", "data engineering", "python programming")

Order = list[str | Column]

WINDOW_LIMIT = 1000  # rows of a group that Spark keeps per task before a shuffle


# --- repeats and order ------------------------------------------------------


def union_feeds(feeds: list[DataFrame], rank: str = "list_rank") -> DataFrame:
    """Feeds one after the other; `rank` keeps which one a row came from."""
    ranked = [feed.withColumn(rank, F.lit(i)) for i, feed in enumerate(feeds)]
    return reduce(lambda a, b: a.unionByName(b), ranked)


def first_seen(feed: DataFrame, key: list[str], order: Order) -> DataFrame:
    """The first row of each key.

    Spark keeps one row per key and task before the shuffle (WindowGroupLimit),
    so a key that holds a third of the feed sends one row per task.
    """
    window = Window.partitionBy(*key).orderBy(*order)
    return feed.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def distinct_keys(feed: DataFrame, key: list[str]) -> DataFrame:
    """The keys alone, when it does not matter which row they came from."""
    return feed.select(*key).distinct()


def top_per_group(
    frame: DataFrame,
    group: list[str],
    order: Order,
    n: int,
    spread_by: list[str],
    buckets: int | None = None,
) -> DataFrame:
    """The first `n` rows of each group, for groups too large for one task.

    Up to WINDOW_LIMIT rows Spark limits a group before it shuffles: the group is ranked in hash buckets
    first, and at most `n` rows of each bucket go on to the final ranking, which is exact. For more,
    rows are dealt by ranges of group and order and get their place from the counts of the ranges
    before them, so no task sorts a group, however large `n` is. Rows equal in `order` are told apart by `spread_by`.
    """
    if n > WINDOW_LIMIT and buckets is None:
        keys = [F.col(o) if isinstance(o, str) else o for o in [*order, *spread_by]]
        return with_places(frame, group, keys).where(F.col("place") < n).drop("place")
    bucketed = frame.withColumn("_bucket", F.pmod(F.xxhash64(*spread_by), F.lit(buckets or 256)))
    for partition in ([*group, "_bucket"], group):
        rank = F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
        bucketed = bucketed.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
    return bucketed.drop("_bucket")


# --- filters and cursors ----------------------------------------------------


def of_type(items: DataFrame, kind: str = STORY_TYPE) -> DataFrame:
    """Rows of one type; null items and null types drop out."""
    return items.where(F.col("type") == kind)


def published_types(events: DataFrame, types: tuple[str, ...] = EVENT_TYPES) -> DataFrame:
    return events.where(F.col("type").isin(*types))


def in_allowed_set(frame: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a table of allowed keys."""
    return frame.join(allowed.select(key), key, "left_semi")


def highest_id(published: DataFrame, id_column: str = "id") -> DataFrame:
    """One row: the highest id published so far, 0 before the first run."""
    highest = F.max(F.col(id_column).try_cast("bigint"))
    return published.agg(F.coalesce(highest, F.lit(0).cast("bigint")).alias("mark"))


def highest_ids(published: DataFrame, by: str, id_column: str) -> DataFrame:
    return published.groupBy(by).agg(F.max(id_column).alias("mark"))


def above_mark(feed: DataFrame, id_column: str, mark: DataFrame) -> DataFrame:
    """Rows above the high-water mark; the mark is a scalar subquery, not a join."""
    return feed.where(F.col(id_column) > mark.scalar())


def not_last(feed: DataFrame, key: str, last: str | int | None) -> DataFrame:
    """Equality cursor: leave out the one row published last."""
    return feed.where(~F.col(key).eqNullSafe(F.lit(last)))


def not_in_history(feed: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Rows whose key no earlier run has seen; the history holds each key once.

    The planner broadcasts the history while it measures small and shuffles both
    sides otherwise. A hot feed key is then split by the adaptive skew join, which
    needs the history to go into the join as it comes, without a `distinct` here.
    """
    return feed.join(history.select(key), key, "left_anti")


def look_up(ids: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """Ids to items; an id that was not fetched drops out."""
    return ids.join(items, key, "inner")


def search(frame: DataFrame, columns: list[str], queries: list[str]) -> DataFrame:
    """Rows that hold a query in any of the columns, ignoring case.

    One output row per query found, with `query_rank` and `query`.
    """
    texts = F.array(*[F.lit(q) for q in queries])
    hits = frame.select("*", F.explode(matched_queries(columns, queries)).alias("query_rank"))
    return hits.withColumn("query", F.get(texts, F.col("query_rank")))


# --- limits -----------------------------------------------------------------


def take(feed: DataFrame, order: Order, n: int | None) -> DataFrame:
    """First `n` rows in feed order; no limit when `n` is 0 or None."""
    return feed.orderBy(*order).limit(n) if n else feed


def cap_pages(
    events: DataFrame, max_pages: int | None = None, rows_per_page: int | None = None
) -> DataFrame:
    """The part of each poll that an API serves; pages count from 1, positions from 0.

    Without a limit everything stays. `beyond_pages` gives what a limit leaves out.
    """
    return events.where(_served(max_pages, rows_per_page))


def beyond_pages(events: DataFrame, max_pages: int | None, rows_per_page: int | None) -> DataFrame:
    """The rows that `cap_pages` with the same limits leaves out."""
    return events.where(~_served(max_pages, rows_per_page))


def _served(max_pages: int | None, rows_per_page: int | None) -> Column:
    page = F.lit(True) if max_pages is None else F.coalesce(F.col("page") <= max_pages, F.lit(False))
    return page if rows_per_page is None else page & F.coalesce(F.col("pos") < rows_per_page, F.lit(False))


def newest(frame: DataFrame, published: str, key: str, n: int) -> DataFrame:
    return frame.orderBy(F.col(published).desc(), key).limit(n)


def most_popular(frame: DataFrame, views: str | Column, key: str, n: int) -> DataFrame:
    column = F.col(views) if isinstance(views, str) else views
    return frame.orderBy(column.desc(), key).limit(n)


# --- seen-id history --------------------------------------------------------


def merge_history(history: DataFrame, seen: DataFrame) -> DataFrame:
    """Union of earlier and new (source, key, seen_at), each key once, last sighting kept."""
    return each_once(history.unionByName(seen))


def each_once(history: DataFrame) -> DataFrame:
    """A history that may name a key several times, each key with its last sighting."""
    return history.groupBy("source", "key").agg(F.max("seen_at").alias("seen_at"))


def bounded_history(history: DataFrame, size: int) -> DataFrame:
    """The newest `size` ids of each source."""
    order: Order = [F.col("seen_at").desc(), "key"]
    return top_per_group(history, ["source"], order, size, spread_by=["key"])


def seen_now(feed: DataFrame, source: str, key: str, seen_at: Column) -> DataFrame:
    return feed.select(
        F.lit(source).alias("source"),
        F.col(key).cast("string").alias("key"),
        seen_at.alias("seen_at"),
    )


# --- whole runs -------------------------------------------------------------


def newest_items(items: DataFrame, key: str, landed_at: str) -> DataFrame:
    """Of an item that was fetched more than once the one that landed last; equal positions go by a hash."""
    fields = F.xxhash64(*[F.to_json(F.struct(c)) for c in items.columns if c != landed_at])
    return first_seen(items, [key], [F.col(landed_at).desc(), fields]).drop(landed_at)


def story_feed(
    lists: DataFrame,
    items: DataFrame,
    order: list[str],
    mark: DataFrame | None = None,
    limit: int | None = None,
    history: DataFrame | None = None,
    text_length: int | None = None,
) -> DataFrame:
    """Ranked id lists and fetched items to story messages in feed order.

    Ids of the history are left out. The mark is applied before repeats are removed: all copies of an id pass it
    or none does, and the rows below it need no shuffle. Items hold each id once (`newest_items`
    sees to that); they are made messages before the join moves them.
    """
    fresh = lists if mark is None else above_mark(lists, "id", mark)
    wanted = first_seen(fresh.where("id IS NOT NULL"), ["id"], [*order, "id"])
    if history is not None:
        wanted = not_in_history(wanted, history.select(F.col("key").try_cast("bigint").alias("id")), "id")
    messages = normalize_story(of_type(items), text_length=text_length)
    return take(look_up(wanted, messages, "id"), [*order, "id"], limit)


def event_feed(
    events: DataFrame,
    order: list[str],
    history: DataFrame | None = None,
    last: str | None = None,
    limit: int | None = None,
    max_pages: int | None = None,
    rows_per_page: int | None = None,
) -> DataFrame:
    """Exploded event pages to event messages in feed order, of all pages unless limited.

    Repeats go before the type filter: the first copy of an id decides.
    """
    served = cap_pages(events, max_pages, rows_per_page)
    if last is not None:
        served = not_last(served, "id", last)
    payload = F.xxhash64("type", "created_at", F.to_json(F.struct("payload")))
    first = first_seen(served.where("id IS NOT NULL"), ["id"], [*order, payload])
    if history is not None:
        first = not_in_history(first, history.select(F.col("key").alias("id")), "id")
    return take(normalize_event(published_types(first), *order), [*order, "id"], limit)


def video_feed(
    popular: DataFrame,
    found: DataFrame,
    details: DataFrame,
    history: DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Popular videos, then search results in query order, as video messages.

    `popular` and `found` hold (list_rank, pos, id); `details` holds the normalised
    videos, one row per id.
    """
    columns = ["list_rank", "pos", "id"]
    ids = popular.select(*columns).unionByName(found.select(*columns))
    wanted = first_seen(ids, ["id"], ["list_rank", "pos"])
    if history is not None:
        wanted = not_in_history(wanted, history.select(F.col("key").alias("id")), "id")
    messages = look_up(wanted, details.withColumn("id", F.col("video_id")), "id")
    return take(messages, ["list_rank", "pos", "id"], limit).drop("id")
