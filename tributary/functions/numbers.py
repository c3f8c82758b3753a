"""Number functions that never raise on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the largest result page the video API serves.
REQUEST_CEILING = 50


def to_count(c: Column | str) -> Column:
    """Text to BIGINT; absent or unreadable text counts as 0."""
    column = F.col(c) if isinstance(c, str) else c
    return F.coalesce(column.try_cast("bigint"), F.lit(0).cast("bigint"))


def clamp(c: Column | str, ceiling: int) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    return F.least(column, F.lit(ceiling))


def clamp_request(n: int, ceiling: int) -> int:
    """The same for a limit that is part of the plan rather than of the data."""
    return min(n, ceiling)
