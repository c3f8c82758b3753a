from __future__ import annotations

import json
import time
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tributary import dated, folders
from tributary.operators.audit import landing_audit
from tributary.operators.conform import silver_rows
from tributary.operators.parse import bronze_rows, landed_rows
from tributary.schemas import KAFKA_RECORD
from tributary.session import STREAMING_OPTIONS
from tributary.sources import bronze, kafka, listing
from tributary.sources.tables import table_stream
from tributary.streaming import ingest
from tributary.streaming.compact import compact
from tributary.streaming.dedup import dedup_stream

START = datetime(2024, 1, 1)


def land(spark, folder, values, topic="hackernews-posts"):
    """One more file of records in a replay folder."""
    rows = [
        (b"k", v.encode(), topic, 0, n, START + timedelta(seconds=n), 0) for n, v in enumerate(values)
    ]
    spark.createDataFrame(rows, KAFKA_RECORD).coalesce(1).write.mode("append").parquet(folder)


def replay(spark, folder):
    return spark.readStream.schema(KAFKA_RECORD).parquet(folder)


def story(i):
    return json.dumps({"id": i, "type": "story", "title": f"t{i}"})


@pytest.fixture
def lake(spark):
    return folders.work_folder(spark, "test-lake")


@pytest.fixture
def topic(spark, lake):
    folder = f"{lake}/replay"
    land(spark, folder, [story(i) for i in range(5)] + ["garbage", "{}"])
    return folder


def run_once(spark, topic, lake, source="hackernews"):
    ingest.drain([ingest.start_bronze(replay(spark, topic), source, lake, ingest.ONCE)])


def test_append_resume_and_new_records(spark, topic, lake):
    run_once(spark, topic, lake)
    assert bronze.read(spark, lake, "hackernews").count() == 5
    run_once(spark, topic, lake)
    assert bronze.read(spark, lake, "hackernews").count() == 5
    land(spark, topic, [story(i) for i in range(5, 8)])
    run_once(spark, topic, lake)
    rows = bronze.read(spark, lake, "hackernews")
    assert sorted(r["id"] for r in rows.collect()) == list(range(8))
    assert rows.columns[-3:] == ["source", "ingested_at", "partition_date"]


def test_partitioned_by_ingestion_date(spark, topic, lake, plan_of):
    run_once(spark, topic, lake)
    leaf = bronze.leaf_path(lake, "hackernews")
    assert any(n.startswith("partition_date=") for n in folders.children(spark, leaf))
    plan = plan_of(bronze.read(spark, lake, "hackernews").where("partition_date = DATE'2020-01-01'"))
    assert "PartitionFilters: [isnotnull(partition_date" in plan


def test_quarantine_keeps_the_text(spark, topic, lake):
    run_once(spark, topic, lake)
    aside = bronze.read_quarantine(spark, lake, "hackernews").collect()
    assert {(r["raw_json"], r["reason"]) for r in aside} == {("garbage", "malformed"), ("{}", "missing key")}


def test_fresh_progress_over_old_sink_is_refused(spark, topic, lake):
    run_once(spark, topic, lake)
    sink = bronze.leaf_path(lake, "hackernews")
    with pytest.raises(ValueError, match="commit log"):
        ingest.guard(spark, sink, f"{lake}/other")
    ingest.guard(spark, sink, bronze.checkpoint_path(lake, "hackernews"))
    ingest.guard(spark, f"{lake}/nothing-yet", f"{lake}/other")


def test_leaf_read_ignores_uncommitted_files(spark, topic, lake):
    run_once(spark, topic, lake)
    leaf = bronze.leaf_path(lake, "hackernews")
    day = next(n for n in folders.children(spark, leaf) if n.startswith("partition_date="))
    stray = spark.createDataFrame([(99, "stray")], "id BIGINT, title STRING")
    stray.write.mode("append").parquet(f"{leaf}/{day}")
    assert bronze.read(spark, lake, "hackernews").count() == 5
    listed = listing.objects_per_source(listing.objects(spark, f"{lake}/bronze")).collect()
    assert [r["source"] for r in listed] == ["hackernews"]
    # The listing shows every object, committed or not.
    assert listed[0]["n_files"] > bronze.committed_files(bronze.read(spark, lake, "hackernews")).count()


def test_older_files_lack_newer_columns(spark, lake):
    leaf = bronze.leaf_path(lake, "hackernews")
    spark.sql("SELECT 1L AS id, 'a' AS title").write.parquet(f"{leaf}/partition_date=2024-01-01")
    spark.sql("SELECT 2L AS id, 'b' AS title, 5L AS score").write.parquet(f"{leaf}/partition_date=2024-01-02")
    declared = {r["id"]: r["score"] for r in bronze.read(spark, lake, "hackernews").collect()}
    assert declared == {1: None, 2: 5}
    merged = bronze.read_leaf(spark, leaf, merge_schema=True)
    assert set(merged.columns) == {"id", "title", "score", "partition_date"}


def test_failing_query_stops_the_others(spark, topic, lake):
    bad = replay(spark, topic).withColumn(
        "value", F.raise_error(F.lit("broken feed")).cast("binary")
    )
    streams = {"hackernews": replay(spark, topic), "github": bad}
    with pytest.raises(Exception, match="broken feed"):
        ingest.ingest(spark, streams, lake, {"processingTime": "0 seconds"}, duration=60)
    assert not [q for q in spark.streams.active if q.isActive]


def test_start_failure_leaves_nothing_running(spark, topic, lake):
    streams = {"hackernews": replay(spark, topic), "nowhere": replay(spark, topic)}
    with pytest.raises(ValueError, match="unknown source"):
        ingest.start_all(streams, lake)
    assert not spark.streams.active


def test_timed_run_ends_on_time(spark, topic, lake):
    empty = f"{lake}/empty"
    spark.createDataFrame([], KAFKA_RECORD).write.parquet(empty)
    run_once(spark, topic, lake)  # an ended query must not end the timed run at once
    started = time.time()
    queries = ingest.ingest(
        spark, {"github": replay(spark, empty)}, lake, {"processingTime": "0 seconds"}, duration=2
    )
    assert 2 <= time.time() - started < 20
    assert not any(q.isActive for q in queries)


def test_rows_read(spark, topic, lake):
    query = ingest.start_bronze(replay(spark, topic), "hackernews", lake, ingest.ONCE)
    ingest.drain([query])
    assert ingest.rows_landed(spark, lake, "hackernews") == 7


def test_batch_and_stream_agree(spark, topic, lake):
    run_once(spark, topic, lake)
    batch = bronze_rows(kafka.raw_json(spark.read.parquet(topic)), "hackernews")
    streamed = bronze.read(spark, lake, "hackernews")
    fields = [c for c in batch.columns if c not in ("ingested_at", "partition_date")]
    assert sorted(map(str, batch.select(fields).collect())) == sorted(map(str, streamed.select(fields).collect()))


def test_compaction_keeps_rows_and_the_source(spark, topic, lake):
    for i in range(5, 8):
        run_once(spark, topic, lake)
        land(spark, topic, [story(i)])
    run_once(spark, topic, lake)
    before = bronze.committed_files(bronze.read_landed(spark, lake, "hackernews")).count()
    wanted = sorted(map(str, bronze.read_landed(spark, lake, "hackernews").collect()))
    target = compact(spark, lake, "hackernews")
    data = f"{bronze.compacted_path(lake, 'hackernews')}/data"
    assert len(dated.folders_of(spark, target)) == 1
    compacted = bronze.read_leaf(spark, f"{data}/{dated.folders_of(spark, target)[0].split('/')[0]}")
    assert compacted.count() == 10 and compacted.where("reason IS NOT NULL").count() == 2
    assert set(bronze.POSITION) <= set(compacted.columns)
    assert bronze.committed_files(compacted).count() < before
    # Readers take the compaction and what lands after it, each row once.
    assert sorted(map(str, bronze.read_landed(spark, lake, "hackernews").collect())) == wanted
    land(spark, topic, [story(50)])
    run_once(spark, topic, lake)
    assert bronze.read(spark, lake, "hackernews").count() == 9
    compact(spark, lake, "hackernews")
    assert bronze.read(spark, lake, "hackernews").count() == 9


@pytest.mark.parametrize("spread_by", [None, ["offset"]])
def test_stream_dedup(spark, lake, spread_by, changed):
    provider = "spark.sql.streaming.stateStore.providerClass"
    changed(**{provider: STREAMING_OPTIONS[provider]})
    folder = f"{lake}/replay"
    land(spark, folder, [story(0)] * 50 + [story(i) for i in range(10)])
    land(spark, folder, [story(0)] * 20 + [story(99)])
    stream = kafka.raw_json(replay(spark, folder), "timestamp", "offset").withColumn(
        "id", F.get_json_object("raw_json", "$.id")
    )
    out = f"out_{uuid.uuid4().hex}"
    query = (
        dedup_stream(stream, ["id"], "timestamp", "100 days", spread_by=spread_by, buckets=4)
        .writeStream.format("memory")
        .queryName(out)
        .outputMode("append")
        .option("checkpointLocation", f"{lake}/progress")
        .trigger(**ingest.ONCE)
        .start()
    )
    ingest.drain([query])
    assert sorted(r["id"] for r in spark.table(out).collect()) == sorted([*map(str, range(10)), "99"])


def test_both_sides_come_out_of_one_parse(spark, topic, lake, plan_of):
    batch = landed_rows(kafka.raw_json(spark.read.parquet(topic)), "hackernews")
    plan = plan_of(batch)
    assert plan.count("from_json") == 1 and "Exchange" not in plan
    assert batch.where("reason IS NULL").count() == 5 and batch.where("raw_json IS NOT NULL").count() == 2


def test_audit_tells_the_sides_apart(spark, topic, lake):
    run_once(spark, topic, lake)
    row = landing_audit(spark, lake, {"hackernews": ["id"]}).first()
    assert (row["n_rows"], row["n_quarantined"], row["has_rows"]) == (5, 2, True)


def test_good_rows_are_read_without_the_text(spark, topic, lake, plan_of):
    run_once(spark, topic, lake)
    plan = plan_of(bronze.read(spark, lake, "hackernews").select("id"))
    assert "ReadSchema: struct<id:bigint,reason:string>" in plan
    aside = plan_of(bronze.read_quarantine(spark, lake, "hackernews"))
    assert "IsNotNull(reason)" in aside


def test_offsets_can_be_kept_and_order_copies(spark, lake):
    folder = f"{lake}/replay"
    land(spark, folder, ['{"id":1,"title":"old"}', '{"id":1,"title":"new"}'])
    ingest.drain(
        [ingest.start_bronze(replay(spark, folder), "hackernews", lake, ingest.ONCE, ("offset",))]
    )
    kept = bronze.read(spark, lake, "hackernews", "offset BIGINT")
    assert sorted(r["offset"] for r in kept.collect()) == [0, 1]
    assert [r["title"] for r in silver_rows(kept, "hackernews").collect()] == ["new"]


def test_table_of_many_files_is_replayed_in_batches(spark, lake):
    spark.range(30).repartition(3).write.parquet(f"{lake}/t.parquet")
    out = f"out_{uuid.uuid4().hex}"
    query = (
        table_stream(spark, lake, "t", max_files_per_trigger=1)
        .writeStream.format("memory")
        .queryName(out)
        .option("checkpointLocation", f"{lake}/progress")
        .trigger(**ingest.ONCE)
        .start()
    )
    ingest.drain([query])
    assert spark.table(out).count() == 30
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3


def test_silver_takes_the_latest_copy(spark):
    rows = [(1, "old", START), (1, "new", START + timedelta(hours=1)), (2, "only", START)]
    frame = spark.createDataFrame(rows, "id BIGINT, title STRING, ingested_at TIMESTAMP")
    bronze_like = frame.selectExpr(
        "id", "title", "'story' AS type", "'' AS by", "0L AS score", "0L AS descendants",
        "0L AS time", "'' AS url", "'' AS text", "'hackernews' AS source", "ingested_at",
    )
    got = {r["id"]: r["title"] for r in silver_rows(bronze_like, "hackernews").collect()}
    assert got == {1: "new", 2: "only"}


def test_silver_picks_the_same_copy_however_rows_are_spread(spark):
    rows = spark.range(200).selectExpr(
        "id % 10 AS id", "concat('t', id) AS title", "'story' AS type", "'' AS by", "0L AS score",
        "0L AS descendants", "0L AS time", "'' AS url", "'' AS text", "'hackernews' AS source",
        "timestamp'2024-01-01 00:00:00' AS ingested_at",
    )
    picks = [
        {r["id"]: r["title"] for r in silver_rows(rows.repartition(n), "hackernews").collect()}
        for n in (1, 3, 7)
    ]
    assert len(picks[0]) == 10 and picks[0] == picks[1] == picks[2]


def test_sources_union_by_name(spark, topic, lake):
    run_once(spark, topic, lake)
    land(spark, f"{lake}/events", ['{"id":"e1","type":"PushEvent"}'], "github-events")
    run_once(spark, f"{lake}/events", lake, "github")
    both = bronze.read_all(spark, lake, ["github", "hackernews"])
    assert {r["id"] for r in both.collect()} == {"e1", "0", "1", "2", "3", "4"}
    assert {tuple(r) for r in both.groupBy("source").count().collect()} == {("github", 1), ("hackernews", 5)}
    assert both.where("source = 'github' AND title IS NULL").count() == 1
