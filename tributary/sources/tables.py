"""Parquet tables of a folder, as batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(
    spark: SparkSession, folder: str, name: str, max_files_per_trigger: int = 10000
) -> DataFrame:
    """The same table replayed from its first file, as a stream.

    The glob serves a single file as well as a folder of part files. The limit on
    files per trigger turns a long replay into batches that are committed one by
    one, so that a failure repeats one batch only.
    """
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{folder}/{name}.[p]arquet")


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    """Avro files; needs the optional reader package on the classpath."""
    return spark.read.format("avro").load(path)
