"""Landed API JSON to rows.

Input rows hold one API response as `raw_json` plus any columns that say where
it stood in the feed (poll, list_rank, page); those are carried along. A response
is bounded by the API's page size, so exploding it never makes a large row group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary import schemas
from tributary.functions.json import READ_OPTIONS
from tributary.functions.text import WHITESPACE


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One response per line; lines that are not JSON stay visible."""
    return spark.read.text(path).withColumnRenamed("value", "raw_json")


def story_lists(responses: DataFrame, *carry: str) -> DataFrame:
    """Ranked id lists to (carry, pos, id)."""
    ids = F.from_json("raw_json", schemas.STORY_LIST)
    return responses.select(*carry, F.posexplode(ids).alias("pos", "id"))


def story_items(responses: DataFrame, *carry: str) -> DataFrame:
    """Single items; a `null` response has no id and can never be looked up."""
    item = F.from_json("raw_json", schemas.STORY_ITEM)
    return responses.select(*carry, F.inline(F.array(item))).where("id IS NOT NULL")


def event_pages(responses: DataFrame, *carry: str) -> DataFrame:
    """Pages of events to (carry, pos, event columns)."""
    events = F.from_json("raw_json", schemas.EVENT_PAGE)
    exploded = responses.select(*carry, F.posexplode(events).alias("pos", "event"))
    return exploded.select(*carry, "pos", "event.*")


def numbered_event_pages(lines: DataFrame) -> DataFrame:
    """Lines `{"page": n, "events": [...]}` to (page, pos, event columns)."""
    line = F.from_json("raw_json", f"page INT, events {schemas.EVENT_PAGE}")
    paged = lines.select(F.inline(F.array(line)))
    exploded = paged.select("page", F.posexplode("events").alias("pos", "event"))
    return exploded.select("page", "pos", "event.*")


def video_envelopes(responses: DataFrame, *carry: str) -> DataFrame:
    """`{"items": [...]}` of video details to (carry, pos, id, snippet, ...)."""
    items = F.from_json("raw_json", schemas.VIDEO_ENVELOPE).getField("items")
    exploded = responses.select(*carry, F.posexplode(items).alias("pos", "item"))
    return exploded.select(*carry, "pos", "item.*")


def search_results(responses: DataFrame, *carry: str) -> DataFrame:
    """`{"items": [{"id": {"videoId": ...}}]}` to (carry, pos, video_id)."""
    items = F.from_json("raw_json", schemas.SEARCH_ENVELOPE).getField("items")
    exploded = responses.select(*carry, F.posexplode(items).alias("pos", "item"))
    return exploded.select(*carry, "pos", F.col("item.id.videoId").alias("video_id"))


# What a line of each landed feed has to be: its outer sign and its schema.
LINES = {
    "story_list": ("[", schemas.STORY_LIST),
    "story_item": ("{", schemas.STORY_ITEM),
    "event_page": ("[", schemas.EVENT_PAGE),
    "numbered_event_page": ("{", f"page INT, events {schemas.EVENT_PAGE}"),
    "video_envelope": ("{", schemas.VIDEO_ENVELOPE),
    "search_envelope": ("{", schemas.SEARCH_ENVELOPE),
}


def line_reason(kind: str, text: str = "raw_json") -> Column:
    """Why a landed line cannot be used, null for a good one.

    A `null` response is good: the service answered that there is nothing.
    """
    sign, schema = LINES[kind]
    line = F.btrim(F.col(text), F.lit(WHITESPACE))
    malformed = F.try_parse_json(text).isNull() | F.col(text).isNull()
    if sign == "{":
        read = F.from_json(text, f"{schema}, {schemas.CORRUPT} STRING", READ_OPTIONS)
        misfit = read.getField(schemas.CORRUPT).isNotNull()
    else:
        misfit = F.from_json(text, schema).isNull()
    return (
        F.when(line == "null", F.lit(None).cast("string"))
        .when(malformed, "malformed")
        .when(~F.startswith(line, F.lit(sign)) | misfit, "unexpected shape")
    )


def split_lines(lines: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(good lines, quarantined lines with source kind and reason); together they are all lines."""
    judged = lines.withColumn("reason", line_reason(kind))
    bad = judged.where("reason IS NOT NULL").withColumn("kind", F.lit(kind))
    return judged.where("reason IS NULL").drop("reason"), bad


# --- elements ---------------------------------------------------------------


@dataclass(frozen=True)
class Elements:
    """Where the elements of a response are and what each has to be.

    `inside` is the field of the response that holds them; None: the response is the list, "": it is the only element.
    `fields` are those of an object; None: an element is a number, the id.
    """

    inside: str | None
    fields: str | None
    key: str


ELEMENTS = {
    "story_list": Elements(None, None, "id"),
    "story_item": Elements("", schemas.STORY_ITEM, "id"),
    "event_page": Elements(None, schemas.EVENT_ITEM, "id"),
    "numbered_event_page": Elements("events", schemas.EVENT_ITEM, "id"),
    "video_envelope": Elements("items", schemas.VIDEO_ITEM, "id"),
    "search_envelope": Elements("items", schemas.SEARCH_ITEM, "id.videoId"),
}


def elements(responses: DataFrame, kind: str, *carry: str) -> DataFrame:
    """(carry, page, pos, raw_json, value, reason): every element of every response, each judged by itself.

    `reason` is null for a good element, and `value` is null for the others:

    - "malformed": the response is not JSON, "error response": it tells of an error instead, "unexpected shape": it is
      not what the feed sends; such a response is one row, without a position;
    - "null element", "unexpected shape", "misfit" (a field cannot be read as declared), "missing key".

    A response `null` says that there is nothing, and has no rows, as a list without elements has none. `page` is
    the number in a numbered page. `raw_json` of an element is its text as it came.
    """
    spec = ELEMENTS[kind]
    line = F.btrim(F.col("raw_json"), F.lit(WHITESPACE))
    parsed = responses.withColumn("_v", F.try_parse_json("raw_json"))
    shape = F.schema_of_variant("_v")
    if spec.inside == "":
        usable = F.startswith(shape, F.lit("OBJECT"))
        values, texts = F.array("_v"), F.array("raw_json")
    elif spec.inside is None:
        usable = F.startswith(shape, F.lit("ARRAY"))
        values = F.try_variant_get("_v", "$", "array<variant>")
        texts = F.from_json("raw_json", "ARRAY<STRING>")
    else:
        values = F.try_variant_get("_v", f"$.{spec.inside}", "array<variant>")
        texts = F.from_json("raw_json", f"{spec.inside} ARRAY<STRING>").getField(spec.inside)
        usable = values.isNotNull()
    error = F.try_variant_get("_v", "$.error", "variant").isNotNull()
    whole = (
        F.when(F.col("_v").isNull(), "malformed")
        .when(error & ~F.coalesce(usable, F.lit(False)), "error response")
        .when(~F.coalesce(usable, F.lit(False)), "unexpected shape")
    )
    page = F.try_variant_get("_v", "$.page", "int") if kind == "numbered_event_page" else F.lit(None).cast("int")
    pairs = F.arrays_zip(texts.alias("text"), values.alias("value"))
    responses = parsed.where(F.col("_v").isNull() | (line != "null")).select(
        *carry, page.alias("page"), "raw_json", whole.alias("_whole"), F.when(whole.isNull(), pairs).alias("_pairs")
    )
    # a response that is bad as a whole stays as one row, one that is good but empty has none
    kept = responses.where("_whole IS NOT NULL OR size(_pairs) > 0")
    each = kept.select(*carry, "page", "raw_json", "_whole", F.posexplode_outer("_pairs").alias("pos", "_pair"))
    each = each.select(
        *carry, "page", "pos", "_whole",
        F.when(F.col("_whole").isNotNull(), F.col("raw_json")).otherwise(F.col("_pair.text")).alias("raw_json"),
        F.schema_of_variant("_pair.value").alias("_shape"),
    )
    if spec.fields:
        read = F.from_json("raw_json", f"STRUCT<{spec.fields}, {schemas.CORRUPT}: STRING>", READ_OPTIONS)
        fits = F.startswith("_shape", F.lit("OBJECT"))
    else:
        read = F.struct(F.col("raw_json").try_cast("bigint").alias("id"), F.lit(None).cast("string").alias(schemas.CORRUPT))
        fits = F.col("_shape") == "BIGINT"
    each = each.withColumn("_read", read)
    key = F.col(f"_read.{spec.key}")
    reason = (
        F.when(F.col("_whole").isNotNull(), F.col("_whole"))
        .when(F.coalesce(F.col("_shape"), F.lit("VOID")) == "VOID", "null element")
        .when(~fits, "unexpected shape")
        .when(F.col(f"_read.{schemas.CORRUPT}").isNotNull(), "misfit")
        .when(key.isNull(), "missing key")
    )
    return each.select(
        *carry, "page", "pos", "raw_json",
        F.when(reason.isNull(), F.col("_read").dropFields(schemas.CORRUPT)).alias("value"), reason.alias("reason"),
    )


def good_elements(judged: DataFrame, *carry: str) -> DataFrame:
    """(carry, fields) of the good ones."""
    return judged.where("reason IS NULL").select(*carry, "value.*")


def bad_elements(judged: DataFrame, kind: str, *carry: str) -> DataFrame:
    return judged.where("reason IS NOT NULL").select(*carry, F.lit(kind).alias("kind"), "pos", "raw_json", "reason")
