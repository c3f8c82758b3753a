from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tributary import schemas
from tributary.operators import parse
from tributary.operators.publish import write_topic
from tributary.sources import kafka

STORY = '{"id":%s,"title":"t"}'


def raw(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "raw_json STRING")


def parsed(spark, source, texts, *columns):
    rows = parse.parse(raw(spark, texts), source).select(*columns).collect()
    return [tuple(r) for r in rows]


def test_counts_and_ids_keep_large_values(spark):
    got = parsed(spark, "hackernews", [STORY % 3000000000], "id", "title")
    assert got == [(3000000000, "t")]
    views = '{"video_id":"v","view_count":9000000000}'
    assert parsed(spark, "youtube", [views], "view_count") == [(9000000000,)]


def test_unreadable_fields_and_names(spark):
    texts = ['{"id":"7","score":"x"}', '{"ID":9}', '{"id":1.5}', '{"id":4,"extra":1}']
    assert parsed(spark, "hackernews", texts, "id", "score") == [
        (None, None), (None, None), (None, None), (4, None),
    ]


def test_event_fields(spark):
    text = '{"id":12,"type":"PushEvent","actor":{"id":1,"login":"a"},"payload":{ "b": 1, "a":[2] },"public":true}'
    got = parsed(spark, "github", [text], "id", "actor.login", "payload", "public")
    assert got == [("12", "a", '{"b":1,"a":[2]}', "true")]
    assert parsed(spark, "github", ['{"id":"1","actor":"oops"}'], "actor") == [(None,)]


def test_video_fields(spark):
    texts = ['{"video_id":"v","tags":"notarr"}', '{"video_id":"v","tags":[]}', '{"video_id":"v","view_count":"12"}']
    assert parsed(spark, "youtube", texts, "tags", "view_count") == [(None, None), ([], None), (None, None)]


def test_quarantine_takes_every_unusable_row(spark):
    good = STORY % 1
    bad = ["garbage", '{"id":"x","title":"t"}', "[1]", "{}", "", None]
    frame = parse.parse(raw(spark, [good, *bad]), "hackernews", "raw_json")
    kept = parse.accepted(frame, "hackernews")
    aside = parse.quarantined(frame, "hackernews")
    assert [r["id"] for r in kept.collect()] == [1]
    assert schemas.CORRUPT not in kept.columns
    reasons = {r["raw_json"]: r["reason"] for r in aside.collect()}
    assert reasons == {
        "garbage": "malformed", '{"id":"x","title":"t"}': "malformed", "[1]": "malformed",
        "{}": "missing key", "": "missing key", None: "missing key",
    }
    assert aside.columns == ["source", "raw_json", "reason", "ingested_at"]


def test_enrich_adds_three_columns(spark):
    row = parse.bronze_rows(raw(spark, [STORY % 1]), "hackernews")
    assert row.columns[-3:] == ["source", "ingested_at", "partition_date"]
    assert dict(row.dtypes)["ingested_at"] == "timestamp" and dict(row.dtypes)["partition_date"] == "date"
    assert row.first()["source"] == "hackernews"


def test_record_columns_can_be_kept(spark):
    frame = raw(spark, [STORY % 1]).withColumn("offset", F.lit(8).cast("bigint"))
    assert parse.bronze_rows(frame, "hackernews", "offset").first()["offset"] == 8


def test_unknown_source_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown source"):
        parse.parse(raw(spark, ["{}"]), "nowhere")


def test_text_is_parsed_once(spark, plan_of):
    frame = raw(spark, [STORY % 1]).repartition(1)
    plan = plan_of(parse.accepted(parse.parse(frame, "hackernews"), "hackernews").select("id"))
    assert plan.count("from_json") == 1


def test_routing(spark):
    topics = ["hackernews-posts", "github-events", "youtube-videos", "other"]
    frame = spark.createDataFrame([(t,) for t in topics], "topic STRING")
    assert [r["source"] for r in kafka.route(frame).collect()] == ["hackernews", "github", "youtube", None]
    assert schemas.topic_routes() == dict(zip(topics, ["hackernews", "github", "youtube"]))


def test_records_have_the_broker_schema(spark):
    frame = spark.range(3).select(F.col("id"), F.lit("{}").alias("v"))
    made = kafka.records(frame, "id", F.col("v"), F.lit("t"), F.lit(0), F.col("id"))
    wanted = spark.createDataFrame([], schemas.KAFKA_RECORD).dtypes
    assert made.dtypes == wanted
    assert [r["raw_json"] for r in kafka.raw_json(made, "offset").collect()] == ["{}"] * 3


def test_topic_options():
    options = kafka.topic_options("host:9092", "github-events")
    assert options == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "github-events",
        "startingOffsets": "earliest", "failOnDataLoss": "false",
    }


def test_batch_options():
    options = kafka.topic_options("host:9092", "t", max_offsets_per_trigger=5, min_partitions=9)
    assert (options["maxOffsetsPerTrigger"], options["minPartitions"]) == ("5", "9")


def test_connector_is_looked_up_late(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka.read_topic(spark, "host:9092", "github-events")
    with pytest.raises(Exception, match="(?i)kafka"):
        write_topic(spark.createDataFrame([("k", "v", "t")], "key STRING, value STRING, topic STRING"), "host:9092")


def test_payload_that_does_not_parse_is_written_as_text(spark):
    import json

    from tributary.functions.json import object_text

    rows = spark.createDataFrame([("1", "{not json}"), ("2", '{"a":1}')], "id STRING, payload STRING")
    made = rows.select(object_text(["id", "payload"], "payload").alias("t")).collect()
    assert [json.loads(r["t"])["payload"] for r in made] == ["{not json}", {"a": 1}]


def test_no_landed_line_vanishes(spark):
    from tributary.sources import landed

    lines = ['{"id": 1}', "garbage", "[1]", "null", "", '{"id": "x"}']
    frame = spark.createDataFrame([(x,) for x in lines], "raw_json STRING")
    good, bad = landed.split_lines(frame, "story_item")
    assert good.count() + bad.count() == len(lines)
    found = {r["raw_json"]: r["reason"] for r in bad.collect()}
    assert found == {"garbage": "malformed", "": "malformed", "[1]": "unexpected shape", '{"id": "x"}': "unexpected shape"}
