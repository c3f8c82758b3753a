"""Record value to bronze columns, with what cannot be used set aside.

Works the same on batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary import schemas
from tributary.functions.json import READ_OPTIONS


def parse(raw: DataFrame, source: str, *keep: str) -> DataFrame:
    """`raw_json` to the source's columns plus the corrupt-record marker.

    The parsed struct is spread with `inline` rather than by projection: a
    filter on its fields is pushed through a projection and would parse the
    text a second time; it stays above a generator.
    """
    return parse_as(raw, schemas.source(source).message, *keep)


def parse_as(raw: DataFrame, schema: str, *keep: str) -> DataFrame:
    """`parse` for a schema given as text."""
    parsed = F.from_json("raw_json", f"{schema}, {schemas.CORRUPT} STRING", READ_OPTIONS)
    return raw.select(*keep, F.inline(F.array(parsed)))


def unusable(source: str) -> Column:
    """True for text that does not fit the schema and for rows without a key.

    The marker alone misses `{}`, empty and null text.
    """
    key = schemas.source(source).key
    return F.col(schemas.CORRUPT).isNotNull() | F.col(key).isNull()


def reason(source: str) -> Column:
    """Why a row cannot be used; null for a good one."""
    return F.when(F.col(schemas.CORRUPT).isNotNull(), "malformed").when(
        F.col(schemas.source(source).key).isNull(), "missing key"
    )


def accepted(parsed: DataFrame, source: str) -> DataFrame:
    return parsed.where(~unusable(source)).drop(schemas.CORRUPT)


def quarantined(parsed: DataFrame, source: str) -> DataFrame:
    """(source, raw_json, reason, ingested_at); parse with `raw_json` kept."""
    return parsed.where(unusable(source)).select(
        F.lit(source).alias("source"),
        "raw_json",
        reason(source).alias("reason"),
        F.current_timestamp().alias("ingested_at"),
    )


def enrich(frame: DataFrame, source: str) -> DataFrame:
    """Add where the row came from and when; both times are fixed per micro-batch."""
    return frame.withColumns(
        {
            "source": F.lit(schemas.source(source).name),
            "ingested_at": F.current_timestamp(),
            "partition_date": F.current_date(),
        }
    )


def landed_rows(raw: DataFrame, source: str, *keep: str) -> DataFrame:
    """Every record once: good rows with their fields, the others also with text and reason.

    Both sides come out of one parse. `raw_json` and `reason` are null for good rows.
    """
    parsed = parse(raw, source, "raw_json", *keep)
    sides = {
        "raw_json": F.when(unusable(source), F.col("raw_json")),
        "reason": reason(source),
    }
    return enrich(parsed.withColumns(sides).drop(schemas.CORRUPT), source)


def bronze_rows(raw: DataFrame, source: str, *keep: str) -> DataFrame:
    """The good rows alone."""
    return enrich(accepted(parse(raw, source, *keep), source), source)
