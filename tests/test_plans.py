"""Plans that must hold when the data is large."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from tributary import folders, jobs, schemas
from tributary.operators import feeds
from tributary.operators.conform import conform_event
from tributary.operators.parse import bronze_rows
from tributary.sources import bronze
from tributary.streaming import ingest


def test_first_seen_limits_before_the_shuffle(spark, plan_of):
    frame = spark.range(100).withColumn("k", F.col("id") % 5)
    plan = plan_of(feeds.first_seen(frame, ["k"], ["id"]))
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in below and "Final" in above


def test_top_per_group_limits_before_each_shuffle(spark, plan_of):
    frame = spark.range(5000).withColumn("g", F.col("id") % 2)
    plan = plan_of(feeds.top_per_group(frame, ["g"], [F.desc("id")], 1000, ["id"]))
    assert len(re.findall(r"WindowGroupLimit.*Partial", plan)) == 2


def test_anti_join_after_dedup_adds_no_shuffle_of_the_feed(spark, plan_of, changed):
    changed(spark__sql__autoBroadcastJoinThreshold="-1")
    feed = spark.range(100).select((F.col("id") % 30).alias("id"), F.col("id").alias("pos"))
    history = spark.range(10)
    plan = plan_of(feeds.not_in_history(feeds.first_seen(feed, ["id"], ["pos"]), history, "id"))
    assert plan.count("Exchange hashpartitioning") == 2


def test_hot_feed_key_is_split_in_the_anti_join(spark, plan_of, changed):
    changed(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    feed = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 < 2, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    history = spark.range(0, 60000, 2, 4).select(F.col("id").alias("k"))
    left = feeds.not_in_history(feed, history, "k")
    rows = left.collect()
    assert len(rows) == 40000 + 10000
    assert "isSkew=true" in plan_of(left) or "skewed" in plan_of(left)


def test_mark_is_a_subquery_not_a_join(spark, plan_of):
    plan = plan_of(feeds.above_mark(spark.range(10), "id", feeds.highest_id(spark.range(3))))
    assert "Subquery" in plan and "Join" not in plan


def test_limit_is_a_top_k(spark, plan_of):
    assert "TakeOrderedAndProject" in plan_of(feeds.take(spark.range(100), ["id"], 5))


def test_no_python_and_no_shuffle_on_the_way_to_silver(spark, plan_of):
    raw = spark.range(5).select(F.format_string('{"id":"%d"}', "id").alias("raw_json"))
    plan = plan_of(conform_event(bronze_rows(raw, "github")))
    assert "Exchange" not in plan and "Python" not in plan


# Row by row work: nothing may be shuffled.
SHUFFLE_FREE = [
    "kafka_parse_roundtrip", "source_routing", "to_kafka_records", "normalize_story", "type_equals",
    "type_in_set", "equality_cursor", "keyword_search", "page_cap", "text_prefix", "title_preview",
    "default_and_null", "iso_duration_seconds", "text_to_count", "request_clamp", "epoch_to_timestamp",
    "iso_to_timestamp", "payload_extract", "tags_split_join", "run_name", "conform_story",
    "conform_event", "conform_video", "cross_source_union", "dq_row_tags",
]
# One shuffle: a single grouping, ranking or unpartitioned count.
ONE_SHUFFLE = [
    "feed_counts", "quarantine_split", "highest_id_per_source", "distinct_in_run", "latest_per_key",
    "union_feeds_first_wins", "silver_dedup", "dq_column_exists", "dq_between", "dq_in_set",
    "dq_of_type", "paged_feed_explode", "normalize_event", "normalize_video",
]


@pytest.mark.parametrize("name", SHUFFLE_FREE + ONE_SHUFFLE)
def test_shuffles_of_a_query(spark, plan_of, name):
    plan = plan_of(spark_entry.queries()[name](spark, "/root/testdata/sf0.001"))
    assert plan.count("Exchange") == (0 if name in SHUFFLE_FREE else 1)
    assert not re.search("Cartesian|NestedLoop|Python|ArrowEval", plan)


def test_type_filters_reach_the_scan(spark, plan_of):
    queries = spark_entry.queries()
    equals = plan_of(queries["type_equals"](spark, "/root/testdata/sf0.001"))
    assert "EqualTo(event_type,purchase)" in equals
    in_set = plan_of(queries["type_in_set"](spark, "/root/testdata/sf0.001"))
    assert "In(event_type, [click,purchase,view])" in in_set


def test_scan_reads_only_what_is_used(spark, plan_of):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = plan_of(feeds.newest(events.select("event_id", "value").where("value > 10"), "value", "event_id", 5))
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan
    assert "GreaterThan(value,10.0)" in plan


def test_top_per_group_beyond_the_group_limit_is_spread(spark, changed):
    changed(spark__sql__shuffle__partitions="200")
    frame = spark.range(9000).withColumn("g", F.col("id") % 2)
    top = feeds.top_per_group(frame, ["g"], [F.desc("id")], 1500, ["id"])
    assert top.count() == 3000


def test_half_of_a_large_group_is_not_sorted_in_one_task(spark, plan_of, changed):
    """A million rows of one group and the half of them that comes first, ties at the edge included."""
    changed(spark__sql__shuffle__partitions="32")
    frame = spark.range(1_000_000).select(F.lit("hot").alias("g"), (F.col("id") % 1000).alias("rank"), "id")
    frame = frame.unionByName(spark.range(7).select(F.lit(None).alias("g"), F.col("id").alias("rank"), "id"))
    top = feeds.top_per_group(frame, ["g"], [F.desc("rank")], 499_500, ["id"])
    found = {r.g: (r.n, r.low, r.ids) for r in top.groupBy("g").agg(F.count("*").alias("n"), F.min("rank").alias("low"), F.count_distinct("id").alias("ids")).collect()}
    assert found == {"hot": (499_500, 500, 499_500), None: (7, 0, 7)}
    # of the rank at the edge the smaller ids are taken
    edge = top.where("g = 'hot' AND rank = 500").agg(F.count("*").alias("n"), F.max("id").alias("last")).first()
    assert (edge.n, edge.last) == (500, 499_500)
    plan = plan_of(top)
    assert "WindowGroupLimit" not in plan
    ranked = plan[plan.index("Window") :]
    assert "__rows" in ranked.splitlines()[0]  # only the counts of the ranges are added up
    sizes = top.where("g = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 200_000


def test_second_read_opens_new_files_only(spark, lake_of_two_batches):
    lake, version = lake_of_two_batches
    tail = bronze.since(spark, lake, "hackernews", version)
    assert tail.batch == 1 and tail.files.count() == 2
    assert [r["id"] for r in tail.rows.collect()] == [2]
    known = [r.file_name for r in spark.read.parquet(f"{version}/files").collect()]
    for path in Path(bronze.leaf_path(lake, "hackernews")).rglob("*.parquet"):
        if path.name in known:
            path.write_text("not a table")  # so a read that opened it would fail
    assert [r["id"] for r in bronze.since(spark, lake, "hackernews", version).rows.collect()] == [2]


@pytest.fixture
def lake_of_two_batches(spark):
    """One story, a version that knows it, then another story."""
    lake, topic = folders.work_folder(spark, "lake"), folders.work_folder(spark, "topic")
    for i in (1, 2):
        message = f'{{"id": {i}, "title": "t", "type": "story", "score": 1, "time": 1704067200}}'
        record = spark.range(1).select(
            F.lit(b"k").alias("key"), F.lit(message).cast("binary").alias("value"), F.lit("t").alias("topic"),
            F.lit(0).alias("partition"), F.lit(i).cast("bigint").alias("offset"), F.current_timestamp().alias("timestamp"),
            F.lit(0).alias("timestampType"),
        )
        record.write.mode("append").parquet(topic)
        stream = spark.readStream.schema(schemas.KAFKA_RECORD).parquet(topic)
        ingest.drain([ingest.start_bronze(stream, "hackernews", lake, ingest.ONCE)])
        if i == 1:
            version = jobs.build_silver(spark, lake, "hackernews")
    return lake, version
