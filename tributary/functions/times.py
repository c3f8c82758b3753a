"""Durations, instants and run names."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Duration form and run-name form.
DURATION = r"^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?"
RUN_STAMP = "yyyyMMdd-HHmmss"
RUN_SUFFIX = "-bronze-to-silver-validation"

# Epoch seconds of years 1 to 9999; outside them the conversion would raise.
FIRST_SECOND = -62135596800
LAST_SECOND = 253402300799


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_duration_seconds(c: Column | str) -> Column:
    """Seconds of an ISO duration, read from the start of the text.

    Days, fractions and anything after the known parts are ignored, so text
    that does not fit gives 0, and so does a part too large for BIGINT.
    """

    def part(group: int) -> Column:
        digits = F.nullif(F.regexp_extract(_column(c), DURATION, group), F.lit(""))
        return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))

    hours = F.try_multiply(part(1), F.lit(3600).cast("bigint"))
    minutes = F.try_multiply(part(2), F.lit(60).cast("bigint"))
    total = F.try_add(F.try_add(hours, minutes), part(3))
    return F.coalesce(total, F.lit(0).cast("bigint"))


def epoch_to_timestamp(c: Column | str) -> Column:
    seconds = _column(c)
    return F.when(seconds.between(FIRST_SECOND, LAST_SECOND), F.timestamp_seconds(seconds))


def iso_to_timestamp(c: Column | str) -> Column:
    """ISO text to an instant; null when it cannot be read."""
    return F.try_to_timestamp(_column(c))


def utc_date(c: Column | str) -> Column:
    """The date of an instant in UTC, whatever time zone the session shows it in."""
    days = F.floor(F.unix_seconds(_column(c)) / F.lit(86400))
    return F.date_from_unix_date(days.cast("int"))


def run_name(ts: Column | str) -> Column:
    return F.concat(F.date_format(_column(ts), RUN_STAMP), F.lit(RUN_SUFFIX))


def run_name_at(moment: datetime, template: str = "%Y%m%d-%H%M%S" + RUN_SUFFIX) -> str:
    return moment.strftime(template)
