"""Object listing by prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def objects(spark: SparkSession, prefix: str, pattern: str = "*") -> DataFrame:
    """(path, length, modified) of every object below a prefix.

    Spark lists the folders; the contents column is never read. Whatever lies
    there is listed, committed or not.
    """
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
    )
    return reader.load(prefix).select(
        "path", "length", F.col("modificationTime").alias("modified")
    )


def objects_per_source(listed: DataFrame, name_part: str = ".parquet") -> DataFrame:
    """Objects whose name holds `name_part`, counted by the source in their path."""
    source = F.regexp_extract("path", r"/source=([^/]+)/", 1)
    return (
        listed.where(F.contains(F.col("path"), F.lit(name_part)))
        .groupBy(source.alias("source"))
        .agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))
    )
