"""JSON text and bytes, with one set of options for the whole engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.schemas import CORRUPT

# The default timestamp format keeps milliseconds only.
WRITE_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}
READ_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "columnNameOfCorruptRecord": CORRUPT,
}


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_json_text(c: Column | str) -> Column:
    """Object to JSON text; nulls are written."""
    return F.to_json(_column(c), WRITE_OPTIONS)


def object_text(fields: list[str], raw_field: str | None = None) -> Column:
    """JSON object of the named columns, in order.

    `raw_field` holds JSON object text already and is put in as it is, so that it
    stays an object and keeps its own key order; what does not parse is written as a text
    value. It is written as null first and
    then replaced; quotes inside text values are escaped, so the mark occurs once.
    """
    if raw_field is None or raw_field not in fields:
        return to_json_text(F.struct(*fields))
    nothing = F.lit(None).cast("string").alias(raw_field)
    frame = to_json_text(F.struct(*[nothing if f == raw_field else F.col(f) for f in fields]))
    member = F.concat(F.lit(f'"{raw_field}":'), F.col(raw_field))
    is_object = F.startswith(F.col(raw_field), F.lit("{")) & F.try_parse_json(raw_field).isNotNull()
    return F.when(is_object, F.replace(frame, F.lit(f'"{raw_field}":null'), member)).otherwise(
        to_json_text(F.struct(*fields))
    )


def to_bytes(c: Column | str) -> Column:
    return F.encode(_column(c), "UTF-8")


def to_text(c: Column | str) -> Column:
    return _column(c).cast("string")


def payload_value(c: Column | str, path: str) -> Column:
    return F.get_json_object(_column(c), path)
