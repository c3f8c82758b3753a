"""Text, default and id-list functions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text lengths and the whitespace a state text is trimmed of.
TEXT_LENGTH = 500
TITLE_LENGTH = 60
WHITESPACE = " \t\n\r\x0b\x0c"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def default_text(c: Column | str) -> Column:
    return F.coalesce(_column(c), F.lit(""))


def default_count(c: Column | str) -> Column:
    return F.coalesce(_column(c), F.lit(0).cast("bigint"))


def default_tags(c: Column | str) -> Column:
    return F.coalesce(_column(c), F.array().cast("array<string>"))


def default_object(c: Column | str) -> Column:
    """JSON object text, `{}` when absent."""
    return F.coalesce(_column(c), F.lit("{}"))


def default_true(c: Column | str) -> Column:
    return F.coalesce(_column(c), F.lit(True))


def text_prefix(c: Column | str, length: int | None = None) -> Column:
    """First `length` code points, all if it is None; null becomes the empty string."""
    if length is None:
        return default_text(c)
    return F.substring(default_text(c), 1, length)


def title_preview(c: Column | str) -> Column:
    return F.substring(_column(c), 1, TITLE_LENGTH)


def strip(c: Column | str) -> Column:
    return F.btrim(_column(c), F.lit(WHITESPACE))


def split_ids(c: Column | str) -> Column:
    """Comma-separated state text to ids; blank text gives no ids."""
    return F.filter(F.split(strip(c), ","), lambda x: x != "")


def join_ids(c: Column | str) -> Column:
    return F.array_join(_column(c), ",")


def null_if_empty(c: Column | str) -> Column:
    return F.nullif(_column(c), F.lit(""))


def contains_ignoring_case(c: Column | str, needle: str) -> Column:
    return F.contains(F.lower(_column(c)), F.lit(needle.lower()))


def matched_queries(columns: Iterable[Column | str], queries: list[str]) -> Column:
    """Positions of the queries found in any of the columns, in query order.

    Plain `contains` on the lowered texts stays inside generated code, which lowers
    each text once. Nothing is joined.
    """
    lowered = [F.lower(default_text(c)) for c in columns]
    ranks = [
        F.when(reduce(or_, [F.contains(text, F.lit(q.lower())) for text in lowered]), F.lit(rank))
        for rank, q in enumerate(queries)
    ]
    return F.array_compact(F.array(*ranks))
