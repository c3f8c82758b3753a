"""Seen-id state kept between runs.

A run appends the ids it saw as a folder of its own, and now and then all of them are
written as one. What is read is the newest finished whole state and the finished runs after
it. A run that dies while writing is not read.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tributary import folders
from tributary.schemas import HISTORY


def run_stamp() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")


COMPACT_AFTER = 32


def save_history(history: DataFrame, root: str, run: str | None = None) -> str:
    """Write the whole state and return its folder; run names sort by time."""
    return _save(history, f"{root.rstrip('/')}/run={run or run_stamp()}")


def append_history(seen: DataFrame, root: str, run: str | None = None) -> str:
    """Write only what one run saw, next to the state before it."""
    return _save(seen, f"{root.rstrip('/')}/run={run or run_stamp()}+")


def _save(history: DataFrame, path: str) -> str:
    """A run is saved once: what a dead attempt left is written over, what is finished stays."""
    if not folders.is_finished(history.sparkSession, path):
        history.select("source", "key", "seen_at").write.mode("overwrite").parquet(path)
        folders.finish(history.sparkSession, path)
    return path


def _in_force(spark: SparkSession, root: str) -> list[str]:
    """The newest finished whole state and the finished runs appended after it."""
    found = folders.finished_versions(spark, root.rstrip("/"))
    whole = [path for path in found if not path.endswith("+")]
    return [path for path in found if not whole or path >= whole[-1]]


def runs_since_compaction(spark: SparkSession, root: str) -> int:
    return sum(path.endswith("+") for path in _in_force(spark, root))


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """The state in force; empty before the first run. Each key is in it once per run that saw it."""
    paths = _in_force(spark, root)
    if not paths:
        return spark.createDataFrame([], HISTORY)
    return spark.read.schema(HISTORY).parquet(*paths)
