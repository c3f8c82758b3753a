"""Scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.json import payload_value
from tributary.functions.numbers import REQUEST_CEILING, clamp, to_count
from tributary.functions.text import (
    TEXT_LENGTH,
    default_text,
    join_ids,
    null_if_empty,
    split_ids,
    text_prefix,
    title_preview,
)
from tributary.functions.times import (
    epoch_to_timestamp,
    iso_duration_seconds,
    iso_to_timestamp,
    run_name,
    utc_date,
)
from tributary.plans import inputs
from tributary.plans.registry import register
from tributary.sources.tables import table

EPOCH_SECONDS = "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"


@register("text_prefix", "SELECT doc_id, substr(text, 1, 500) AS text FROM documents")
def prefix(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", text_prefix("text", TEXT_LENGTH).alias("text"))


@register("title_preview", "SELECT doc_id, substr(text, 1, 60) AS title FROM documents")
def preview(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", title_preview("text").alias("title"))


@register(
    "default_and_null",
    "SELECT doc_id, CASE WHEN lang = 'en' THEN source ELSE '' END AS by, "
    "CASE WHEN lang = 'en' THEN source END AS key FROM documents",
)
def default_and_null(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    by = default_text(F.when(F.col("lang") == "en", F.col("source")))
    return documents.select("doc_id", by.alias("by"), null_if_empty(by).alias("key"))


@register(
    "iso_duration_seconds",
    "SELECT l_orderkey, l_linenumber, CASE l_returnflag "
    "WHEN 'R' THEN CAST(l_quantity AS BIGINT) * 60 "
    "WHEN 'A' THEN CAST(l_linenumber AS BIGINT) * 3600 + CAST(l_quantity AS BIGINT) * 60 + l_suppkey "
    "ELSE 0 END AS seconds FROM lineitem",
)
def duration(spark: SparkSession, folder: str) -> DataFrame:
    """Minutes only, a full duration with text after it, and one counted in days."""
    minutes = F.col("l_quantity").cast("bigint")
    full = F.concat(
        F.lit("PT"), "l_linenumber", F.lit("H"), minutes, F.lit("M"), "l_suppkey", F.lit("S junk")
    )
    text = (
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("PT"), minutes, F.lit("M")))
        .when(F.col("l_returnflag") == "A", full)
        .otherwise(F.concat(F.lit("P"), "l_linenumber", F.lit("DT2H")))
    )
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", iso_duration_seconds(text).alias("seconds")
    )


@register(
    "text_to_count",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN o_custkey ELSE 0 END "
    "AS n FROM orders",
)
def text_to_count(spark: SparkSession, folder: str) -> DataFrame:
    """Unreadable text, a number, and nothing at all."""
    text = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).when(
        F.col("o_orderstatus") == "O", F.col("o_custkey").cast("string")
    )
    return table(spark, folder, "orders").select("o_orderkey", to_count(text).alias("n"))


@register(
    "request_clamp",
    "SELECT l_orderkey, l_linenumber, least(l_suppkey, 50) AS n FROM lineitem",
)
def request_clamp(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", clamp("l_suppkey", REQUEST_CEILING).alias("n"))


@register(
    "epoch_to_timestamp",
    "SELECT event_id, 1000000 * (epoch_us(ts) // 1000000) AS posted_us, "
    "strftime(ts, '%Y-%m-%d') AS event_date FROM events",
)
def epoch(spark: SparkSession, folder: str) -> DataFrame:
    posted = epoch_to_timestamp(F.expr(EPOCH_SECONDS))
    return table(spark, folder, "events").select(
        "event_id",
        F.unix_micros(posted).alias("posted_us"),
        utc_date(posted).cast("string").alias("event_date"),
    )


@register(
    "iso_to_timestamp",
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN epoch_us(o_orderdate) END AS ordered_us "
    "FROM orders",
)
def iso(spark: SparkSession, folder: str) -> DataFrame:
    """Finished orders have an empty date text."""
    text = F.when(F.col("o_orderstatus") == "F", F.lit("")).otherwise(
        F.date_format("o_orderdate", inputs.ISO_SECONDS)
    )
    return table(spark, folder, "orders").select(
        "o_orderkey", F.unix_micros(iso_to_timestamp(text)).alias("ordered_us")
    )


@register("payload_extract", "SELECT event_id, props->>'$.k' AS k FROM events")
def payload(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.select("event_id", payload_value("props", "$.k").alias("k"))


@register(
    "tags_split_join",
    "WITH parts AS (SELECT doc_id, list_filter(string_split(trim(text, "
    "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), ','), lambda x: x <> '') AS tags "
    "FROM documents) SELECT doc_id, len(tags) AS n_tags, array_to_string(tags, ',') AS joined "
    "FROM parts",
)
def tags(spark: SparkSession, folder: str) -> DataFrame:
    split = table(spark, folder, "documents").select("doc_id", split_ids("text").alias("tags"))
    return split.select(
        "doc_id", F.size("tags").cast("bigint").alias("n_tags"), join_ids("tags").alias("joined")
    )


@register(
    "run_name",
    "SELECT event_id, strftime(ts, '%Y%m%d-%H%M%S') || '-bronze-to-silver-validation' AS run_name "
    "FROM events",
)
def run_names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", run_name("ts").alias("run_name"))
