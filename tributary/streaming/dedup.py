"""Streaming dedup by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_stream(
    stream: DataFrame,
    key: list[str],
    event_time: str,
    delay: str,
    spread_by: list[str] | None = None,
    buckets: int = 64,
) -> DataFrame:
    """One row per key while its state lasts; repeats later than `delay` pass.

    A streaming dedup shuffles every row by key, so a hot key would land in one
    task. With `spread_by` (columns that differ between copies) the copies are
    first reduced in `buckets` parts of each key, and only what is left is
    brought together by the key alone.
    """
    marked = stream.withWatermark(event_time, delay)
    if spread_by:
        bucket = F.pmod(F.xxhash64(*spread_by), F.lit(buckets))
        spread = marked.withColumn("_bucket", bucket)
        marked = spread.dropDuplicatesWithinWatermark([*key, "_bucket"]).drop("_bucket")
    return marked.dropDuplicatesWithinWatermark(key)
