"""Kafka-shaped records: broker scan, record building and routing.

Every function but `read_topic` takes any DataFrame with the record columns,
batch or streaming, so a replayed table stands in for a broker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.json import to_bytes, to_text
from tributary.functions.text import null_if_empty
from tributary.schemas import topic_routes


def topic_options(
    bootstrap: str,
    topic: str,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Replay from the start on first run; lost offsets are tolerated by default.

    `max_offsets_per_trigger` bounds a batch when a long backlog is replayed, and
    `min_partitions` reads a topic of few partitions with more tasks than that.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def read_topic(spark: SparkSession, bootstrap: str, topic: str, **options) -> DataFrame:
    """Stream one topic; the connector is looked up only when this is called."""
    reader = spark.readStream.format("kafka")
    return reader.options(**topic_options(bootstrap, topic, **options)).load()


def raw_json(records: DataFrame, *keep: str) -> DataFrame:
    """Decode the record value; `keep` names record columns to carry along."""
    return records.select(to_text("value").alias("raw_json"), *keep)


def records(
    rows: DataFrame,
    key: Column | str,
    value: Column,
    topic: Column,
    partition: Column,
    offset: Column,
    timestamp: Column | None = None,
) -> DataFrame:
    """Rows in the shape the broker scan gives, for replay without a broker."""
    key_column = F.col(key) if isinstance(key, str) else key
    return rows.select(
        to_bytes(null_if_empty(key_column.cast("string"))).alias("key"),
        to_bytes(value).alias("value"),
        topic.alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        (F.current_timestamp() if timestamp is None else timestamp).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def route(rows: DataFrame, routes: dict[str, str] | None = None) -> DataFrame:
    """Add `source` by topic. The map is part of the expression, so no join runs.

    A topic without a route gets null and can be told apart.
    """
    entries = routes or topic_routes()
    lookup = F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])
    return rows.withColumn("source", F.try_element_at(lookup, F.col("topic")))
