"""Bronze tables: paths, the commit log, leaf reads, unions, committed files.

A leaf folder has its own commit log and is the only thing that is ever read:
a read of the folder above would also see files that were never committed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary import dated, folders, schemas

# Null for good rows; what cannot be used is kept as text, with the reason.
ASIDE = "raw_json STRING, reason STRING"
ADDED = "source STRING, ingested_at TIMESTAMP, partition_date DATE"
# Where the record stood in its topic: later copies of a key stand further on.
POSITION = ("partition", "offset", "timestamp")
POSITION_SCHEMA = "partition INT, offset BIGINT, timestamp TIMESTAMP"


def leaf_path(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/bronze/source={schemas.source(source).name}"


def checkpoint_path(root: str, source: str) -> str:
    """Always next to the data it belongs to."""
    return f"{root.rstrip('/')}/_checkpoints/source={schemas.source(source).name}"


def read_leaf(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """As the files say; merging opens the footer of every file, so it is for audits."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def compacted_path(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/compacted/source={schemas.source(source).name}"


# --- what has been committed ------------------------------------------------


def newest_batch(spark: SparkSession, leaf: str) -> int:
    """The number of the last committed micro-batch, -1 before the first."""
    return max((int(name.split(".")[0]) for name in _log_names(spark, leaf)), default=-1)


def _log_names(spark: SparkSession, leaf: str) -> list[str]:
    return [n for n in folders.children(spark, f"{leaf}/_spark_metadata") if re.fullmatch(r"\d+(\.compact)?", n)]


def commit_log(spark: SparkSession, leaf: str) -> DataFrame:
    """(batch, file_name, size) of every committed file, from the sink's own log.

    Now and then the sink writes all earlier entries into one file; they have the number of the batch
    that did. So a number says until when a file was committed, and files of two reads are
    told apart by their names, which are unique. A leaf that a batch job wrote has no log; its files
    with rows are all there is, as batch -1.
    """
    names = folders.children(spark, leaf)
    if "_spark_metadata" not in names and names:
        rows = spark.read.schema(ADDED).parquet(leaf)
        return rows.select(F.lit(-1).cast("bigint").alias("batch"), "_metadata.file_name", F.col("_metadata.file_size").alias("size")).distinct()
    numbers = {int(name.split(".")[0]): name for name in _log_names(spark, leaf)}
    whole = max((n for n, name in numbers.items() if name.endswith(".compact")), default=-1)
    entries = []
    for number in sorted(n for n in numbers if n >= whole):
        # Spark's own readers leave the folder of the log out, so its lines come as text
        lines = spark.sparkContext.textFile(f"{leaf}/_spark_metadata/{numbers[number]}")
        entry = spark.read.schema("path STRING, size BIGINT, action STRING").json(lines)
        entries.append(entry.where("action = 'add'").withColumn("batch", F.lit(number).cast("bigint")))
    if not entries:
        return spark.createDataFrame([], "batch BIGINT, file_name STRING, size BIGINT")
    return reduce(DataFrame.unionByName, entries).select(
        "batch", F.substring_index("path", "/", -1).alias("file_name"), "size"
    )


@dataclass(frozen=True)
class Tail:
    """Rows of the files that a version did not know, all files known now, and the batch up to which they go."""

    rows: DataFrame
    files: DataFrame
    batch: int


def since(spark: SparkSession, root: str, source: str, version: str | None, *keep: str) -> Tail:
    """What was committed after the version in folder `version` was made; everything without one.

    A version keeps the names of the files it was made from, so no clock decides what is new. Rows, files and
    number are of the same batch. Only the new files are opened.
    """
    leaf, columns = leaf_path(root, source), _columns(source, *keep)
    while True:  # until no batch is committed between looking and reading
        batch = newest_batch(spark, leaf)
        names = folders.children(spark, leaf)
        if batch < 0 and ("_spark_metadata" in names or not names):
            nothing = spark.createDataFrame([], "file_name STRING")
            return Tail(spark.createDataFrame([], columns), nothing, batch)
        rows = spark.read.schema(columns).parquet(leaf)
        files = commit_log(spark, leaf).select("file_name")
        if newest_batch(spark, leaf) == batch:
            break
    if version is None:
        return Tail(rows, files, batch)
    known = spark.read.schema("file_name STRING").parquet(f"{version}/files")
    new = [r.file_name for r in files.join(known, "file_name", "left_anti").collect()]
    return Tail(rows.where(F.col("_metadata.file_name").isin(new)), files, batch)


def _columns(source: str, *keep: str) -> str:
    further = [c for c in keep if c.split()[0].strip("`") not in POSITION]
    return ", ".join([*further, schemas.source(source).message, POSITION_SCHEMA, ASIDE, ADDED])


def read_landed(spark: SparkSession, root: str, source: str, *keep: str) -> DataFrame:
    """Good and quarantined rows of a source, with the declared schema.

    Rows come from the newest finished compaction and from the files committed since. No
    footer is read, and files written before a column was added give null for it. `keep`
    declares further columns stored next to the message, those of the position are always there.
    """
    base = compacted_path(root, source)
    newest = folders.newest_version(spark, base)
    tail = since(spark, root, source, newest, *keep).rows
    if newest is None:
        return tail
    return dated.read(spark, base, newest, _columns(source, *keep), "partition_date").unionByName(tail)


def good(landed: DataFrame) -> DataFrame:
    """The good rows. The text column is not scanned."""
    return landed.where("reason IS NULL").drop("raw_json", "reason")


def read(spark: SparkSession, root: str, source: str, *keep: str) -> DataFrame:
    return good(read_landed(spark, root, source, *keep))


def read_quarantine(spark: SparkSession, root: str, source: str) -> DataFrame:
    """What could not be used. Row groups without any are skipped by their statistics."""
    landed = read_landed(spark, root, source)
    return landed.where("reason IS NOT NULL").select("source", "raw_json", "reason", "ingested_at")


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column a source lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_text_key(frame: DataFrame, source: str) -> DataFrame:
    """The key as text: sources differ in its type, and a union would turn text into numbers."""
    key = schemas.source(source).key
    return frame.withColumn(key, F.col(key).cast("string"))


def read_all(spark: SparkSession, root: str, sources: list[str]) -> DataFrame:
    return union_sources([with_text_key(read(spark, root, s), s) for s in sources])


def committed_files(frame: DataFrame) -> DataFrame:
    """(file_path, n_rows, n_quarantined) of the files with rows; at most the reason column is scanned."""
    aside = F.count("reason") if "reason" in frame.columns else F.lit(0).cast("bigint")
    return frame.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        (F.count("*") - aside).alias("n_rows"), aside.alias("n_quarantined")
    )
