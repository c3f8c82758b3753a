"""Record streams to bronze tables: start, guard, wait, stop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tributary import folders, schemas
from tributary.operators.parse import landed_rows
from tributary.sources import bronze, kafka

# Fixed value: how often a running query looks for new records.
TRIGGER = {"processingTime": "10 seconds"}
ONCE = {"availableNow": True}


def guard(spark: SparkSession, sink: str, checkpoint: str) -> None:
    """Refuse a fresh checkpoint over a sink that has a commit log.

    The sink would take the new batches for ones it already holds and drop them.
    """
    if folders.exists(spark, f"{sink}/_spark_metadata") and not folders.exists(
        spark, f"{checkpoint}/offsets"
    ):
        raise ValueError(f"{sink} has a commit log but {checkpoint} has no progress to go with it")


def start_bronze(
    records: DataFrame,
    source: str,
    root: str,
    trigger: dict = TRIGGER,
    keep: tuple[str, ...] = bronze.POSITION,
    at: Column | None = None,
) -> StreamingQuery:
    """Append a record stream to the source's bronze table.

    Good and unusable records are told apart in one parse and committed together,
    each exactly once. Nothing is shuffled: an input split becomes one task and one
    file. `keep` names record columns to store next to the message. `at` is the time of
    ingestion instead of the session's clock; readers do not go by either.
    """
    sink, checkpoint = bronze.leaf_path(root, source), bronze.checkpoint_path(root, source)
    guard(records.sparkSession, sink, checkpoint)
    rows = landed_rows(kafka.raw_json(records, *keep), source, *keep)
    if at is not None:
        rows = rows.withColumn("ingested_at", at).withColumn("partition_date", F.to_date("ingested_at"))
    return (
        rows.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .partitionBy("partition_date")
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def start_all(streams: dict[str, DataFrame], root: str, trigger: dict = TRIGGER) -> list[StreamingQuery]:
    """One independent query per source; if one cannot start, none is left running."""
    started: list[StreamingQuery] = []
    try:
        for source, records in streams.items():
            started.append(start_bronze(records, schemas.source(source).name, root, trigger))
    except BaseException:
        stop_all(started)
        raise
    return started


def stop_all(queries: list[StreamingQuery]) -> None:
    for query in queries:
        query.stop()


def drain(queries: list[StreamingQuery]) -> None:
    """Wait for queries that end by themselves; a failure stops the others."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        stop_all(queries)


def ingest(
    spark: SparkSession,
    streams: dict[str, DataFrame],
    root: str,
    trigger: dict = TRIGGER,
    duration: int | None = None,
) -> list[StreamingQuery]:
    """Run the sources until `duration` seconds pass, any query ends, or an interrupt.

    Whatever the reason, every query is stopped; a query's error is raised.
    """
    spark.streams.resetTerminated()
    queries = start_all(streams, root, trigger)
    try:
        if duration is None:
            spark.streams.awaitAnyTermination()
        else:
            spark.streams.awaitAnyTermination(duration)
    except KeyboardInterrupt:
        pass
    finally:
        stop_all(queries)
    return queries


def rows_landed(spark: SparkSession, root: str, source: str) -> int:
    """Records a source has committed, good or not, however many batches that took.

    Counted from the files' own statistics; a query only keeps its last reports.
    """
    return bronze.read_landed(spark, root, source).count()
