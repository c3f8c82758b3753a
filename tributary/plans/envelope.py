"""Records, parsing, routing and topic counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.json import to_json_text
from tributary.operators.audit import catalogue_audit, topic_audit, topic_message_count
from tributary.operators.parse import parse, parse_as, reason
from tributary.operators.publish import published_count, to_kafka_records
from tributary.plans import inputs
from tributary.plans.registry import register
from tributary.sources import bronze, kafka
from tributary.sources.definitions import CATALOGUE, topic_catalogue
from tributary.sources.tables import table

EVENT_COLUMNS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
ROUTES = {"click": "hackernews", "view": "github", "purchase": "youtube"}
TOPICS = {"click": "hackernews-posts", "view": "github-events", "purchase": "youtube-videos"}

# The declared topic settings.
DECLARED_TOPICS = """{
  "topics": {
    "hackernews-posts": {"partitions": 3, "retention_ms": 86400000},
    "github-events": {"partitions": 3, "retention_ms": 86400000, "cleanup_policy": "delete"},
    "youtube-videos": {"partitions": 1, "retention_ms": 86400000, "cleanup_policy": "delete"}
  },
  "common_config": {"replication_factor": 1, "min_insync_replicas": 1, "max_message_bytes": 1048576}
}"""


def positioned(rows: DataFrame, topic: Column | None = None) -> DataFrame:
    """Event rows as records of a three-partition topic."""
    return kafka.records(
        rows,
        "event_id",
        to_json_text(F.struct(*rows.columns)),
        topic if topic is not None else F.col("event_type"),
        F.col("event_id") % 3,
        F.expr("event_id DIV 3"),
    )


@register(
    "kafka_parse_roundtrip",
    "SELECT event_id, epoch_us(ts) AS ts_us, user_id, event_type, value, props, "
    "CAST(event_id AS VARCHAR) AS record_key FROM events",
)
def kafka_parse_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    sent = positioned(table(spark, folder, "events"))
    raw = kafka.raw_json(sent, "key")
    parsed = parse_as(raw, EVENT_COLUMNS, "key").where("_corrupt IS NULL")
    return parsed.select(
        "event_id",
        F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)").alias("ts_us"),
        "user_id",
        "event_type",
        "value",
        "props",
        F.col("key").cast("string").alias("record_key"),
    )


@register(
    "source_routing",
    "SELECT e.event_id, e.event_type AS topic, r.source FROM events e LEFT JOIN "
    "(VALUES ('click', 'hackernews'), ('view', 'github'), ('purchase', 'youtube')) r(topic, source) "
    "ON e.event_type = r.topic",
)
def source_routing(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_id", F.col("event_type").alias("topic"))
    return kafka.route(rows, ROUTES)


@register(
    "feed_counts",
    "SELECT 'github' AS source, count(*) AS n_published FROM events UNION ALL "
    "SELECT 'hackernews', count(*) FROM documents UNION ALL "
    "SELECT 'youtube', count(*) FROM pages",
)
def feed_counts(spark: SparkSession, folder: str) -> DataFrame:
    frames = [
        table(spark, folder, name).select(F.lit(source).alias("source"))
        for source, (name, _) in inputs.MESSAGES.items()
    ]
    return published_count(bronze.union_sources(frames))


ERROR = "event_type = 'error'"
RECORD_VALUE_SQL = f"""
    '{{"id":"' || event_id || '","type":"' || {inputs.EVENT_TYPE_SQL}
    || '","actor":{{"id":' || user_id || ',"login":"'
    || CASE WHEN {ERROR} THEN '' ELSE 'user' || user_id END
    || '"}},"repo":"user' || user_id || '/' || event_type
    || '","created_at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
    || '","payload":' || CASE WHEN {ERROR} THEN '{{}}' ELSE '{{"k":' || (props->>'$.k') || '}}' END
    || ',"public":' || CASE WHEN event_type = 'signup' THEN 'false' ELSE 'true' END || '}}'
"""


@register(
    "quarantine_split",
    f"SELECT 'accepted' AS side, {inputs.EVENT_TYPE_SQL} AS detail, count(*) AS n, "
    "CAST(NULL AS BIGINT) AS n_chars FROM events WHERE event_type NOT IN ('error', 'signup') "
    "GROUP BY event_type UNION ALL "
    f"SELECT 'quarantine', 'malformed', count(*), CAST(sum(length({RECORD_VALUE_SQL}) - 1) AS BIGINT) "
    "FROM events WHERE event_type = 'error' UNION ALL "
    "SELECT 'quarantine', 'missing key', count(*), 2 * count(*) FROM events "
    "WHERE event_type = 'signup'",
)
def quarantine_split(spark: SparkSession, folder: str) -> DataFrame:
    records = inputs.event_records(table(spark, folder, "events"))
    return split_counts(parse(kafka.raw_json(damage(records)), "github", "raw_json"))


def damage(records: DataFrame) -> DataFrame:
    """Error events arrive without their closing brace, signups as empty objects."""
    text = F.col("value").cast("string")
    kind = F.get_json_object(text, "$.type")
    broken = (
        F.when(kind == "GollumEvent", F.substring(text, F.lit(1), F.length(text) - 1))
        .when(kind == "CreateEvent", F.lit("{}"))
        .otherwise(text)
    )
    return records.withColumn("value", F.encode(broken, "UTF-8"))


def split_counts(parsed: DataFrame) -> DataFrame:
    """Both sides counted in one pass over the parsed text."""
    why = reason("github")
    return (
        parsed.groupBy(
            F.when(why.isNull(), "accepted").otherwise("quarantine").alias("side"),
            F.coalesce(why, "type").alias("detail"),
        )
        .agg(F.count("*").alias("n"), F.sum(F.length("raw_json")).alias("n_chars"))
        .withColumn("n_chars", F.when(F.col("side") == "quarantine", F.col("n_chars")))
    )


@register(
    "to_kafka_records",
    f"SELECT CAST(event_id AS VARCHAR) AS key, {RECORD_VALUE_SQL} AS value, "
    "'github-events' AS topic FROM events",
)
def kafka_records(spark: SparkSession, folder: str) -> DataFrame:
    return to_kafka_records(inputs.event_messages(table(spark, folder, "events")), "github")


@register(
    "topic_message_count",
    "SELECT topic, count(*) AS n_partitions, CAST(sum(end_offset) AS BIGINT) AS n_messages FROM "
    "(SELECT event_type AS topic, event_id % 3 AS part, max(event_id // 3) + 1 AS end_offset "
    "FROM events GROUP BY ALL) GROUP BY topic",
)
def message_count(spark: SparkSession, folder: str) -> DataFrame:
    return topic_message_count(positioned(table(spark, folder, "events")))


@register(
    "topic_audit",
    "SELECT topic, CAST(coalesce(sum(end_offset), 0) AS BIGINT) AS n_messages, "
    "coalesce(sum(end_offset), 0) > 0 AS success FROM (VALUES ('click'), ('view'), ('refund')) "
    "t(topic) LEFT JOIN (SELECT event_type AS topic, event_id % 3 AS part, "
    "max(event_id // 3) + 1 AS end_offset FROM events GROUP BY ALL) USING (topic) GROUP BY topic",
)
def audited_topics(spark: SparkSession, folder: str) -> DataFrame:
    """Two topics with messages and one that has none."""
    return topic_audit(positioned(table(spark, folder, "events")), ["click", "view", "refund"])


@register(
    "topic_catalogue",
    "WITH declared(topic, partitions) AS (VALUES ('hackernews-posts', 3), ('github-events', 3), "
    "('youtube-videos', 1)), found AS (SELECT CASE event_type WHEN 'click' THEN 'hackernews-posts' "
    "WHEN 'view' THEN 'github-events' WHEN 'purchase' THEN 'youtube-videos' ELSE 'unrouted' END "
    "AS topic, CAST(count(DISTINCT event_id % 3) AS INTEGER) AS partitions FROM events GROUP BY 1) "
    "SELECT topic, CAST(d.partitions AS BIGINT) AS declared_partitions, "
    "CAST(f.partitions AS BIGINT) AS found_partitions, "
    "CASE WHEN d.partitions IS NOT NULL THEN 86400000 END AS declared_retention_ms, "
    "CASE WHEN f.partitions IS NOT NULL THEN 86400000 END AS found_retention_ms, "
    "CASE WHEN topic IN ('github-events', 'youtube-videos') THEN 'delete' END AS declared_cleanup_policy, "
    "CASE WHEN f.partitions IS NOT NULL THEN 'delete' END AS found_cleanup_policy, "
    "coalesce(d.partitions = f.partitions AND topic = 'github-events', false) AS success "
    "FROM declared d FULL OUTER JOIN found f USING (topic)",
)
def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    document = spark.range(1).select(F.from_json(F.lit(DECLARED_TOPICS), CATALOGUE).alias("d"))
    declared = topic_catalogue(document.select("d.*"))
    topic = F.coalesce(inputs.lookup(TOPICS, "event_type"), F.lit("unrouted"))
    found = topic_message_count(positioned(table(spark, folder, "events"), topic))
    # What a broker reports for topics that were made with its defaults.
    found = found.select(
        "topic",
        F.col("n_partitions").cast("int").alias("partitions"),
        F.lit(86400000).cast("bigint").alias("retention_ms"),
        F.lit("delete").alias("cleanup_policy"),
    )
    settings = ["partitions", "retention_ms", "cleanup_policy"]
    return catalogue_audit(declared, found, settings).select(
        "topic",
        *[f"{side}_{s}" for s in settings[1:] for side in ("declared", "found")],
        F.col("declared_partitions").cast("bigint").alias("declared_partitions"),
        F.col("found_partitions").cast("bigint").alias("found_partitions"),
        "success",
    )
