"""Messages to Kafka records, and their delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary import schemas
from tributary.functions.json import object_text
from tributary.functions.text import null_if_empty

# Delivery settings.
DELIVERY = {
    "kafka.acks": "all",
    "kafka.retries": "5",
    "kafka.linger.ms": "50",
    "kafka.batch.size": "16384",
}


def to_kafka_records(messages: DataFrame, source: str, *carry: str) -> DataFrame:
    """(key, value, topic): the entity id as text and the message as one JSON object.

    An empty id becomes a null key. Columns that are not message fields, such as
    the feed position, stay out of the value; `carry` keeps some next to it.
    """
    spec = schemas.source(source)
    value = object_text(spec.schema.names, spec.raw_json_field)
    return messages.select(
        null_if_empty(F.col(spec.key).cast("string")).alias("key"),
        value.alias("value"),
        F.lit(spec.topic).alias("topic"),
        *carry,
    )


def write_topic(records: DataFrame, bootstrap: str, **options: str) -> None:
    """Send records to the broker; needs the connector on the classpath."""
    writer = records.write.format("kafka").options(**DELIVERY)
    writer.option("kafka.bootstrap.servers", bootstrap).options(**options).save()


def published_count(frame: DataFrame) -> DataFrame:
    return frame.groupBy("source").agg(F.count("*").alias("n_published"))
