"""Bronze to silver, and what is read across sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary import folders, jobs, schemas
from tributary.operators import conform, feeds
from tributary.operators.parse import bronze_rows
from tributary.operators.publish import to_kafka_records
from tributary.plans import inputs
from tributary.plans.feeds import EVENT_FIELDS_SQL, STORY_FIELDS_SQL, VIDEO_FIELDS_SQL
from tributary.plans.registry import register
from tributary.sources import bronze, kafka
from tributary.sources.tables import table
from tributary.streaming import ingest


@register(
    "conform_story",
    f"SELECT * EXCLUDE (time), time, 1000000 * time AS posted_us, "
    "strftime(make_timestamp(1000000 * time), '%Y-%m-%d') AS event_date, 'hackernews' AS source "
    f"FROM (SELECT {STORY_FIELDS_SQL} FROM documents)",
)
def conform_story(spark: SparkSession, folder: str) -> DataFrame:
    silver = conform.conform_story(inputs.bronze_of(spark, folder, "hackernews"))
    return plain(silver, "posted_at", "posted_us")


@register(
    "conform_event",
    f"SELECT id, type, epoch_us(date_trunc('second', ts)) AS created_us, actor_login, "
    "repo AS repo_name, actor_id, payload, public, strftime(ts, '%Y-%m-%d') AS event_date, "
    f"'github' AS source FROM (SELECT ts, {EVENT_FIELDS_SQL} FROM events)",
)
def conform_event(spark: SparkSession, folder: str) -> DataFrame:
    silver = conform.conform_event(inputs.bronze_of(spark, folder, "github"))
    return plain(silver, "created_at", "created_us")


@register(
    "conform_video",
    f"SELECT * EXCLUDE (published_at, channel), channel AS channel_title, "
    "epoch_us(CAST(published_at AS TIMESTAMP)) AS published_us, "
    "substr(published_at, 1, 10) AS event_date, 'youtube' AS source "
    f"FROM (SELECT {VIDEO_FIELDS_SQL} FROM pages)",
)
def conform_video(spark: SparkSession, folder: str) -> DataFrame:
    silver = conform.conform_video(inputs.bronze_of(spark, folder, "youtube"))
    return plain(silver.withColumn("tags", F.array_join("tags", ",")), "published_at", "published_us")


def plain(silver: DataFrame, instant: str, micros: str) -> DataFrame:
    """Without the time of the run; instants as microseconds and dates as text."""
    return (
        silver.withColumn(micros, F.unix_micros(instant))
        .withColumn("event_date", F.col("event_date").cast("string"))
        .drop("ingested_at", instant)
    )


@register(
    "latest_per_key",
    "SELECT user_id, event_id, event_type, value, epoch_us(ts) AS ts_us FROM (SELECT *, "
    "row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth FROM events) "
    "WHERE nth = 1",
)
def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    latest = feeds.first_seen(events, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    return latest.select("user_id", "event_id", "event_type", "value", micros.alias("ts_us"))


def older_and_newer(spark: SparkSession, folder: str) -> DataFrame:
    """Every event message as two records of one batch: an older one of another kind, then the real one."""
    messages = inputs.event_messages(table(spark, folder, "events"))
    older = messages.withColumn("type", F.lit("OldEvent")).withColumn("payload", F.lit("{}"))
    records = [
        kafka.records(
            to_kafka_records(sent, "github", "event_id"), "key", F.col("value"), F.col("topic"),
            F.col("event_id") % 3, F.expr(f"2 * (event_id DIV 3) + {later}"),
        )
        for later, sent in enumerate((older, messages))
    ]
    return records[0].unionByName(records[1])


@register(
    "silver_dedup",
    f"SELECT id, type, actor_login, repo AS repo_name, payload FROM "
    f"(SELECT {EVENT_FIELDS_SQL} FROM events)",
)
def silver_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """An older and a newer copy of each key in one batch: the newer one is in silver."""
    raw = kafka.raw_json(older_and_newer(spark, folder), *bronze.POSITION)
    silver = conform.silver_rows(bronze_rows(raw, "github", *bronze.POSITION), "github")
    return silver.select("id", "type", "actor_login", "repo_name", "payload")


@register(
    "silver_incremental",
    f"SELECT id, type, actor_login, repo AS repo_name, payload, event_date FROM "
    f"(SELECT strftime(ts, '%Y-%m-%d') AS event_date, {EVENT_FIELDS_SQL} FROM events)",
)
def silver_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Old copies of half the keys are landed and built, then all real ones; the second build reads those only."""
    root, replay = folders.work_folder(spark, "lake"), folders.work_folder(spark, "replay")
    records = older_and_newer(spark, folder)
    halves = [records.where("offset % 2 = 0 AND offset % 4 = 0"), records.where("offset % 2 = 1")]
    for half in halves:
        half.write.mode("append").parquet(replay)
        stream = spark.readStream.schema(schemas.KAFKA_RECORD).parquet(replay)
        ingest.drain([ingest.start_bronze(stream, "github", root, ingest.ONCE)])
        jobs.build_silver(spark, root, "github")
    silver = jobs.read_silver(spark, root, "github")
    return silver.select(
        "id", "type", "actor_login", "repo_name", "payload", F.col("event_date").cast("string").alias("event_date")
    )


@register(
    "silver_touched_dates",
    "SELECT strftime(ts, '%Y-%m-%d') AS event_date, count(*) AS n_rows, "
    "bool_or(event_id % 4 = 1 AND event_id % 100 = 1) AS rewritten FROM events GROUP BY 1",
)
def silver_touched_dates(spark: SparkSession, folder: str) -> DataFrame:
    """All events are built, then newer copies of a few; only the dates of these are in a folder of the second run."""
    root, replay = folders.work_folder(spark, "lake"), folders.work_folder(spark, "replay")
    records = inputs.event_records(table(spark, folder, "events"))
    few = records.where("CAST(CAST(key AS STRING) AS BIGINT) % 100 = 1 AND CAST(CAST(key AS STRING) AS BIGINT) % 4 = 1")
    built = []
    for part in (records, few.withColumn("offset", F.col("offset") + 1)):
        part.write.mode("append").parquet(replay)
        stream = spark.readStream.schema(schemas.KAFKA_RECORD).parquet(replay)
        ingest.drain([ingest.start_bronze(stream, "github", root, ingest.ONCE)])
        built.append(jobs.build_silver(spark, root, "github"))
    silver = jobs.read_silver(spark, root, "github")
    run = F.regexp_extract("_metadata.file_path", "(run=[^/]*)/event_date=", 1)
    last = built[-1].rsplit("/", 1)[-1]
    return silver.groupBy(F.col("event_date").cast("string").alias("event_date")).agg(
        F.count("*").alias("n_rows"), F.bool_or(run == last).alias("rewritten")
    )


@register(
    "cross_source_union",
    "SELECT 'hackernews' AS source, CAST(doc_id AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS video_id, "
    f"type FROM (SELECT doc_id, {STORY_FIELDS_SQL} FROM documents) UNION ALL "
    f"SELECT 'github', id, NULL, type FROM (SELECT {EVENT_FIELDS_SQL} FROM events) UNION ALL "
    "SELECT 'youtube', NULL, 'v' || page_id, NULL FROM pages",
)
def cross_source_union(spark: SparkSession, folder: str) -> DataFrame:
    frames = [
        bronze.with_text_key(inputs.bronze_of(spark, folder, s), s) for s in inputs.MESSAGES
    ]
    return bronze.union_sources(frames).select("source", "id", "video_id", "type")
