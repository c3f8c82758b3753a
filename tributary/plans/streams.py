"""Streams run to the end over whole tables, and what they leave behind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary import folders, jobs, schemas
from tributary.operators.audit import landing_audit
from tributary.plans import inputs
from tributary.plans.envelope import RECORD_VALUE_SQL, damage
from tributary.plans.feeds import EVENT_FIELDS_SQL, flat_event
from tributary.plans.registry import register
from tributary.sources import bronze, listing
from tributary.sources.tables import table, table_stream
from tributary.streaming import ingest
from tributary.streaming.compact import compact
from tributary.streaming.dedup import dedup_stream


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.event_records(table_stream(spark, folder, "events"))


def source_streams(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """A record stream per source, each replaying its own table."""
    return {
        source: inputs.records_of(messages(table_stream(spark, folder, name)), source)
        for source, (name, messages) in inputs.MESSAGES.items()
    }


def land_events(spark: SparkSession, folder: str) -> str:
    root = folders.work_folder(spark, "lake")
    ingest.drain([ingest.start_bronze(event_stream(spark, folder), "github", root, ingest.ONCE)])
    return root


@register("bronze_stream_append", f"SELECT {EVENT_FIELDS_SQL}, 'github' AS source FROM events")
def bronze_stream_append(spark: SparkSession, folder: str) -> DataFrame:
    """Events replayed as records, parsed, appended to bronze and read back."""
    landed = bronze.read(spark, land_events(spark, folder), "github")
    return flat_event(landed, "source").withColumn("public", F.col("public").cast("boolean"))


@register(
    "stream_resume",
    f"SELECT {inputs.EVENT_TYPE_SQL} AS type, count(*) AS n FROM events GROUP BY 1",
)
def stream_resume(spark: SparkSession, folder: str) -> DataFrame:
    """A second run on the same progress adds nothing."""
    root = land_events(spark, folder)
    ingest.drain([ingest.start_bronze(event_stream(spark, folder), "github", root, ingest.ONCE)])
    return bronze.read(spark, root, "github").groupBy("type").agg(F.count("*").alias("n"))


@register(
    "quarantine_stream",
    "SELECT 'malformed' AS reason, count(*) AS n, "
    f"CAST(sum(length({RECORD_VALUE_SQL}) - 1) AS BIGINT) AS n_chars FROM events "
    "WHERE event_type = 'error' UNION ALL SELECT 'missing key', count(*), 2 * count(*) FROM events "
    "WHERE event_type = 'signup'",
)
def quarantine_stream(spark: SparkSession, folder: str) -> DataFrame:
    root = folders.work_folder(spark, "lake")
    records = damage(event_stream(spark, folder))
    ingest.drain([ingest.start_bronze(records, "github", root, ingest.ONCE)])
    aside = bronze.read_quarantine(spark, root, "github")
    return aside.groupBy("reason").agg(
        F.count("*").alias("n"), F.sum(F.length("raw_json")).alias("n_chars")
    )


LANDED_SQL = (
    "SELECT 'github' AS source, count(*) AS n_rows FROM events UNION ALL "
    "SELECT 'hackernews', count(*) FROM documents UNION ALL SELECT 'youtube', count(*) FROM pages"
)


@register("timed_multi_query", LANDED_SQL)
def timed_multi_query(spark: SparkSession, folder: str) -> DataFrame:
    """Three queries run for a second and are stopped wherever they are; a run to the
    end then goes on from their progress, so each record lands exactly once."""
    root = folders.work_folder(spark, "lake")
    often = {"processingTime": "0 seconds"}
    ingest.ingest(spark, source_streams(spark, folder), root, often, duration=1)
    ingest.drain(ingest.start_all(source_streams(spark, folder), root, ingest.ONCE))
    landed = bronze.read_all(spark, root, list(inputs.MESSAGES))
    return landed.groupBy("source").agg(F.count("*").alias("n_rows"))


@register(
    "landing_audit",
    "SELECT source, CAST(1 AS BIGINT) AS n_files, n_rows, CAST(0 AS BIGINT) AS n_quarantined, "
    "'' AS missing_columns, true AS has_files, n_rows > 0 AS has_rows, "
    f"true AS has_columns FROM ({LANDED_SQL}) WHERE source <> 'youtube' UNION ALL "
    "SELECT 'youtube', 1, count(*), 0, 'duration', true, count(*) > 0, false FROM pages",
)
def landed_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Every source audited for its own columns, one also for a column it does not have."""
    root = folders.work_folder(spark, "lake")
    streams = source_streams(spark, folder)
    ingest.drain(ingest.start_all(streams, root, ingest.ONCE))
    required = {s: [*schemas.source(s).schema.names, "partition_date"] for s in inputs.MESSAGES}
    required["youtube"].append("duration")
    audited = landing_audit(spark, root, required)
    # How many files there are depends on how the tables are split; that each has rows does not.
    return audited.withColumn("n_files", F.least("n_files", F.lit(1).cast("bigint")))


@register(
    "object_listing",
    "SELECT 'github' AS source, count(*) > 0 AS has_files FROM events",
)
def object_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Objects below the bronze prefix, by the source in their path."""
    listed = listing.objects(spark, f"{land_events(spark, folder)}/bronze", "*.parquet")
    return listing.objects_per_source(listed).select(
        "source", (F.col("n_files") > 0).alias("has_files")
    )


@register(
    "bronze_compaction",
    f"SELECT {EVENT_FIELDS_SQL}, CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS offset FROM events",
)
def bronze_compaction(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the events landed and compacted, the rest landed after it; a read has each row once."""
    root, replay = folders.work_folder(spark, "lake"), folders.work_folder(spark, "replay")
    events = table(spark, folder, "events")
    for test in ("event_id % 2 = 0", "event_id % 2 = 1"):
        inputs.event_records(events.where(test)).write.mode("append").parquet(replay)
        stream = spark.readStream.schema(schemas.KAFKA_RECORD).parquet(replay)
        ingest.drain([ingest.start_bronze(stream, "github", root, ingest.ONCE)])
        if test.endswith("0"):
            compact(spark, root, "github")
    landed = bronze.read(spark, root, "github")
    return flat_event(landed, "partition", "offset").withColumn("public", F.col("public").cast("boolean"))


@register(
    "bronze_clock_step",
    f"SELECT layer, id, type, actor_login, payload FROM (SELECT {EVENT_FIELDS_SQL} FROM events), "
    "(VALUES ('bronze'), ('silver')) l(layer)",
)
def bronze_clock_step(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the events land under a clock two days ahead and go into a compaction and silver; the rest land with the
    clock set back, before them by date and time, and are in both all the same."""
    root, replay = folders.work_folder(spark, "lake"), folders.work_folder(spark, "replay")
    events = table(spark, folder, "events")
    for test, ahead in (("event_id % 2 = 0", 2), ("event_id % 2 = 1", 0)):
        inputs.event_records(events.where(test)).write.mode("append").parquet(replay)
        stream = spark.readStream.schema(schemas.KAFKA_RECORD).parquet(replay)
        at = F.current_timestamp() + F.make_dt_interval(days=F.lit(ahead))
        ingest.drain([ingest.start_bronze(stream, "github", root, ingest.ONCE, at=at)])
        if ahead:
            compact(spark, root, "github")
        jobs.build_silver(spark, root, "github")
    sides = [("bronze", bronze.read(spark, root, "github")), ("silver", jobs.read_silver(spark, root, "github"))]
    columns = ["id", "type", "payload"]
    logins = {"bronze": "actor.login", "silver": "actor_login"}
    return bronze.union_sources(
        [rows.select(F.lit(side).alias("layer"), *columns, F.col(logins[side]).alias("actor_login")) for side, rows in sides]
    )


@register("stream_dedup", "SELECT DISTINCT user_id FROM events")
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Users seen in a stream, once each; the delay covers the whole replay."""
    stream = table_stream(spark, folder, "events").select(
        "user_id", "event_id", F.col("ts").cast("timestamp").alias("seen_at")
    )
    users = dedup_stream(stream, ["user_id"], "seen_at", "400 days", spread_by=["event_id"])
    root = folders.work_folder(spark, "dedup")
    query = (
        users.select("user_id")
        .writeStream.format("parquet")
        .option("path", f"{root}/users")
        .option("checkpointLocation", f"{root}/progress")
        .outputMode("append")
        .trigger(**ingest.ONCE)
        .start()
    )
    ingest.drain([query])
    return bronze.read_leaf(spark, f"{root}/users")


@register(
    "batch_stream_parity",
    f"SELECT side, e.* FROM (SELECT {EVENT_FIELDS_SQL} FROM events) e, (VALUES ('batch'), ('stream')) s(side)",
)
def batch_stream_parity(spark: SparkSession, folder: str) -> DataFrame:
    """The same transform in batch and as a stream."""
    streamed = bronze.read(spark, land_events(spark, folder), "github")
    batch = inputs.bronze_of(spark, folder, "github")
    sides = [("stream", streamed), ("batch", batch)]
    return bronze.union_sources(
        [
            flat_event(frame.withColumn("side", F.lit(side)), "side").withColumn(
                "public", F.col("public").cast("boolean")
            )
            for side, frame in sides
        ]
    )

