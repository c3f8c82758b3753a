from __future__ import annotations

import json
from pathlib import Path
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary import folders
from tributary.operators import feeds, normalize, state
from tributary.operators.parse import accepted, parse
from tributary.operators.publish import DELIVERY, published_count, to_kafka_records
from tributary.schemas import STORY_MESSAGE
from tributary.sources import landed

LISTS = [(0, "[5,3]"), (1, "[3,9]")]
ORDER = ["list_rank", "pos"]


def responses(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "raw_json STRING")


def lists(spark, rows=LISTS):
    frame = spark.createDataFrame(rows, "list_rank INT, raw_json STRING")
    return landed.story_lists(frame, "list_rank")


def items(spark, types, **fields):
    texts = [json.dumps({"id": i, "type": t, "title": f"t{i}", **fields}) for i, t in types.items()]
    return landed.story_items(responses(spark, [*texts, "null", "not json"]))


def ids(frame, column="id", order=ORDER):
    return [r[column] for r in frame.orderBy(*order).collect()]


def test_lists_keep_rank_order(spark):
    got = [tuple(r) for r in lists(spark).orderBy(*ORDER).select("list_rank", "pos", "id").collect()]
    assert got == [(0, 0, 5), (0, 1, 3), (1, 0, 3), (1, 1, 9)]


def test_first_occurrence_wins(spark):
    assert ids(feeds.first_seen(lists(spark), ["id"], ORDER)) == [5, 3, 9]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.integers(0, 20), max_size=20), min_size=1, max_size=3))
def test_first_seen_like_a_loop_and_idempotent(spark, ranked):
    rows = [(i, json.dumps(r)) for i, r in enumerate(ranked)]
    expected = list(dict.fromkeys(x for r in ranked for x in r))
    once = feeds.first_seen(lists(spark, rows), ["id"], ORDER)
    assert ids(once) == expected
    assert ids(feeds.first_seen(once, ["id"], ORDER)) == expected


def test_story_run(spark):
    found = items(spark, {5: "story", 3: "job", 9: "story"})
    run = feeds.story_feed(lists(spark), found, ORDER)
    assert ids(run) == [5, 9]
    limited = feeds.story_feed(lists(spark), found, ORDER, limit=1)
    assert ids(limited) == [5]
    everything = feeds.story_feed(lists(spark), found, ORDER, limit=0)
    assert ids(everything) == [5, 9]


def test_missing_item_drops_the_id(spark):
    assert ids(feeds.story_feed(lists(spark), items(spark, {9: "story"}), ORDER)) == [9]


def test_high_water_mark(spark):
    published = spark.createDataFrame([(2,), (4,)], "id BIGINT")
    mark = feeds.highest_id(published)
    assert ids(feeds.first_seen(feeds.above_mark(lists(spark), "id", mark), ["id"], ORDER)) == [5, 9]
    nothing = feeds.highest_id(published.where("id < 0"))
    assert nothing.first()["mark"] == 0
    found = items(spark, {5: "story", 3: "story", 9: "story"})
    assert ids(feeds.story_feed(lists(spark), found, ORDER, mark=mark)) == [5, 9]


def test_normalised_story_defaults(spark):
    long = "x" * 600
    texts = [json.dumps({"id": 1, "type": "story"}), json.dumps({"id": 2, "type": "job", "title": None, "text": long})]
    got = normalize.normalize_story(landed.story_items(responses(spark, texts)), text_length=500).orderBy("id").collect()
    assert got[0].asDict() == {
        "id": 1, "title": "", "type": "story", "by": "", "score": 0, "descendants": 0,
        "time": 0, "url": "", "text": "",
    }
    assert got[1]["title"] == "" and got[1]["text"] == long[:500]


def event(i, kind="PushEvent", **fields):
    return {
        "id": i, "type": kind, "actor": {"id": 7, "display_login": "ann"},
        "repo": {"name": "ann/x"}, "created_at": "2024-01-01T00:00:00Z", **fields,
    }


def pages(spark, *found):
    rows = [(n + 1, json.dumps(p)) for n, p in enumerate(found)]
    return landed.event_pages(spark.createDataFrame(rows, "page INT, raw_json STRING"), "page")


def test_event_run(spark):
    feed = pages(
        spark,
        [event("a", payload={"z": 1, "b": 2}, public=False), event("b", "GollumEvent"), event("c", None)],
        [event("a"), event("d", "WatchEvent"), event("b", "PushEvent")],
    )
    order = ["page", "pos"]
    run = feeds.event_feed(feed, order)
    # b is a repeat of a row whose type is not published: the first copy decides.
    assert ids(run, order=order) == ["a", "d"]
    first, second = run.orderBy(*order).collect()
    assert first["payload"] == '{"z":1,"b":2}' and first["public"] is False
    assert second["payload"] == "{}" and second["public"] is True
    assert first["actor"]["login"] == "ann" and first["repo"] == "ann/x"


def test_event_cursors(spark):
    feed = pages(spark, [event("a"), event("b"), event("c")])
    order = ["page", "pos"]
    assert ids(feeds.event_feed(feed, order, last="b"), order=order) == ["a", "c"]
    history = spark.createDataFrame([("a",), ("c",)], "key STRING")
    assert ids(feeds.event_feed(feed, order, history=history), order=order) == ["b"]
    assert ids(feeds.event_feed(feed, order, limit=2), order=order) == ["a", "b"]


def test_page_cap(spark):
    feed = pages(spark, *[[event(f"{n}")] for n in range(12)])
    assert feeds.event_feed(feed, ["page", "pos"]).count() == 12
    assert feeds.event_feed(feed, ["page", "pos"], max_pages=10).count() == 10
    long = pages(spark, [event(str(n)) for n in range(120)])
    assert feeds.cap_pages(long).count() == 120
    assert feeds.cap_pages(long, rows_per_page=100).count() == 100
    assert feeds.beyond_pages(long, 10, 100).count() == 20


def video(i, title="t", views="5", published="2024-01-01T00:00:00Z", **fields):
    return {
        "id": i,
        "snippet": {"title": title, "channelTitle": "c", "publishedAt": published, "description": "d", **fields},
        "statistics": {"viewCount": views, "likeCount": "x"},
        "contentDetails": {"duration": "PT1M"},
    }


def details(spark, *found):
    return landed.video_envelopes(responses(spark, [json.dumps({"items": list(found)})]))


def test_normalised_video(spark):
    frame = details(spark, video("v1", tags=["a", "b"]), {"id": "v2"})
    one, two = normalize.normalize_video(frame).orderBy("video_id").collect()
    assert (one["view_count"], one["like_count"], one["comment_count"]) == (5, 0, 0)
    assert one["tags"] == ["a", "b"] and one["duration_seconds"] == 60
    assert two["title"] == "" and two["tags"] == [] and two["duration_seconds"] == 0


def test_video_run(spark):
    known = normalize.normalize_video(details(spark, *[video(f"v{n}", views=str(n)) for n in range(5)]))
    popular = spark.createDataFrame([(0, 0, "v4"), (0, 1, "v3")], "list_rank INT, pos INT, id STRING")
    found = landed.search_results(
        responses(spark, [json.dumps({"items": [{"id": {"videoId": v}} for v in ("v3", "v1", "gone")]})])
    ).select(F.lit(1).alias("list_rank"), "pos", F.col("video_id").alias("id"))
    run = feeds.video_feed(popular, found, known)
    assert ids(run, "video_id") == ["v4", "v3", "v1"]
    history = spark.createDataFrame([("v4",)], "key STRING")
    assert ids(feeds.video_feed(popular, found, known, history=history, limit=1), "video_id") == ["v3"]


def test_search_carries_the_query(spark):
    frame = spark.createDataFrame([("a", "Technology"), ("b", "data engineering and technology")], "id STRING, t STRING")
    got = feeds.search(frame, ["t"], list(feeds.SEARCH_QUERIES)).orderBy("id", "query_rank").collect()
    assert [(r["id"], r["query"]) for r in got] == [
        ("a", "technology"), ("b", "technology"), ("b", "data engineering"),
    ]


def test_newest_and_popular(spark):
    frame = spark.createDataFrame([(f"{n:03d}", n % 7) for n in range(90)], "id STRING, n INT")
    assert feeds.newest(frame, "n", "id", 70).count() == 70
    top = [(r["n"], r["id"]) for r in feeds.most_popular(frame, "n", "id", 3).collect()]
    assert top == [(6, "006"), (6, "013"), (6, "020")]


def test_top_per_group_is_exact_for_a_hot_group(spark):
    frame = spark.range(5000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 11)).alias("g"),
        F.col("id").alias("key"),
        (F.col("id") * 7919 % 5003).alias("v"),
    )
    got = {(r["g"], r["key"]) for r in feeds.top_per_group(frame, ["g"], [F.desc("v"), "key"], 20, ["key"]).collect()}
    by_group: dict = {}
    for r in frame.collect():
        by_group.setdefault(r["g"], []).append((-r["v"], r["key"]))
    assert got == {(g, key) for g, rows in by_group.items() for _, key in sorted(rows)[:20]}


def test_history_is_merged_and_bounded(spark):
    start = datetime(2024, 1, 1)
    old = [("youtube", f"k{n:04d}", start + timedelta(seconds=n)) for n in range(1200)]
    seen = [("youtube", "k0000", start + timedelta(days=1)), ("github", "x", start)]
    schema = "source STRING, key STRING, seen_at TIMESTAMP"
    merged = feeds.merge_history(spark.createDataFrame(old, schema), spark.createDataFrame(seen, schema))
    assert merged.count() == 1201
    kept = feeds.bounded_history(merged, 1000)
    keys = {r["key"] for r in kept.where("source = 'youtube'").collect()}
    assert len(keys) == 1000 and "k0000" in keys
    assert keys == {"k0000", *(f"k{n:04d}" for n in range(201, 1200))}
    assert kept.where("source = 'github'").count() == 1


def test_history_survives_runs(spark):
    root = folders.work_folder(spark, "state-test")
    assert state.read_history(spark, root).count() == 0
    row = [("github", "a", datetime(2024, 1, 1))]
    first = spark.createDataFrame(row, "source STRING, key STRING, seen_at TIMESTAMP")
    state.save_history(first, root, "001")
    second = first.withColumn("key", F.lit("b"))
    path = state.save_history(state.read_history(spark, root).unionByName(second), root, "002")
    assert {r["key"] for r in state.read_history(spark, root).collect()} == {"a", "b"}
    # A run that did not finish has no mark of ours, and the state before it stays.
    spark.createDataFrame([], first.schema).write.parquet(f"{root}/run=003")
    assert folders.exists(spark, f"{path}/{folders.FINISHED}")
    assert {r["key"] for r in state.read_history(spark, root).collect()} == {"a", "b"}
    # Appended runs count on top of the newest whole state, and hold their own ids only.
    state.append_history(first.withColumn("key", F.lit("c")), root, "004")
    assert {r["key"] for r in state.read_history(spark, root).collect()} == {"a", "b", "c"}
    assert state.runs_since_compaction(spark, root) == 1


def test_versions_of_which_none_is_finished_are_an_error(spark):
    root = folders.work_folder(spark, "state-test")
    spark.createDataFrame([], "source STRING, key STRING, seen_at TIMESTAMP").write.parquet(f"{root}/run=001")
    assert state.read_history(spark, root).count() == 0  # a first run that died: nothing yet
    seen = spark.createDataFrame([("s", "a", datetime(2024, 1, 1))], "source STRING, key STRING, seen_at TIMESTAMP")
    path = state.append_history(seen, root, "002")
    assert state.read_history(spark, root).count() == 1
    for found in (Path(path) / "_FINISHED", Path(path) / "._FINISHED.crc"):
        found.unlink(missing_ok=True)
    with pytest.raises(ValueError, match="is finished"):
        state.read_history(spark, root)


def test_seen_now_has_the_state_schema(spark):
    frame = spark.createDataFrame([(7,)], "id BIGINT")
    row = feeds.seen_now(frame, "hackernews", "id", F.lit(datetime(2024, 1, 1))).first()
    assert row.asDict() == {"source": "hackernews", "key": "7", "seen_at": datetime(2024, 1, 1)}


def test_kafka_records(spark):
    feed = pages(spark, [event("", payload={"z": 1, "b": {"c": None}}), event("k")])
    made = to_kafka_records(feeds.event_feed(feed, ["page", "pos"]), "github").collect()
    by_key = {r["key"]: json.loads(r["value"]) for r in made}
    assert set(by_key) == {None, "k"}
    assert list(by_key["k"]) == ["id", "type", "actor", "repo", "created_at", "payload", "public"]
    assert by_key[None]["payload"] == {"z": 1, "b": {"c": None}}
    assert by_key["k"]["payload"] == {} and by_key["k"]["public"] is True
    assert {r["topic"] for r in made} == {"github-events"}
    assert DELIVERY["kafka.acks"] == "all"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.text(min_size=1), st.text(), st.text()), min_size=1, max_size=10))
def test_any_text_survives_the_record(spark, rows):
    items = [
        (i, title, kind, note, i, i, i, "", title + note)
        for i, (title, kind, note) in enumerate(rows)
    ]
    messages = spark.createDataFrame(items, STORY_MESSAGE)
    sent = to_kafka_records(messages, "hackernews").withColumnRenamed("value", "raw_json")
    back = accepted(parse(sent, "hackernews"), "hackernews").orderBy("id").collect()
    assert [tuple(r) for r in back] == items


def test_published_count(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("b",)], "source STRING")
    assert {tuple(r) for r in published_count(frame).collect()} == {("a", 2), ("b", 1)}


def test_not_last_and_allowed_set(spark):
    frame = spark.createDataFrame([("a",), ("b",), (None,)], "id STRING")
    assert {r["id"] for r in feeds.not_last(frame, "id", "a").collect()} == {"b", None}
    allowed = spark.createDataFrame([("b",), ("b",)], "id STRING")
    assert [r["id"] for r in feeds.in_allowed_set(frame, allowed, "id").collect()] == ["b"]
