"""Small-file compaction of a bronze table."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tributary import dated, folders
from tributary.operators.state import run_stamp
from tributary.sources import bronze


def compact(spark: SparkSession, root: str, source: str) -> str:
    """Write the committed rows of a source, good or not, as a new version in larger files.

    The version names the files of the stream that it holds, and readers take it and what was
    committed since. Only the dates that got new rows are written again, the others stay in the folders
    of the version before. All columns of the leaf are kept. Rows are rebalanced by date: Spark splits a
    large day over several tasks and joins small ones. The stream's own folder is never touched.
    """
    leaf, base = bronze.leaf_path(root, source), bronze.compacted_path(root, source)
    if bronze.newest_batch(spark, leaf) < 0:
        raise ValueError(f"nothing has landed for {source}")
    stored = bronze.read_leaf(spark, leaf).schema
    before = folders.newest_version(spark, base)
    tail = bronze.since(spark, root, source, before)
    further = [f"`{f.name}` {f.dataType.simpleString()}" for f in stored if f.name not in tail.rows.columns]
    if further:
        tail = bronze.since(spark, root, source, before, *further)
    touched = dated.dates(tail.rows, "partition_date")
    rows = tail.rows
    if before:
        rows = dated.read(spark, base, before, rows.schema, "partition_date", touched).unionByName(rows)
    path = dated.write(spark, base, run_stamp(), rows, "partition_date", touched, before)
    tail.files.write.parquet(f"{path}/files")
    folders.finish(spark, path)
    return path
