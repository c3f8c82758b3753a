"""Landed files to checked silver, end to end, without a broker."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tributary import dated, folders, jobs
from tributary.__main__ import main
from tributary.operators import quality, results, state
from tributary.schemas import KAFKA_RECORD
from tributary.sources import bronze
from tributary.streaming import ingest
from tributary.streaming.compact import compact


@pytest.fixture
def feed(tmp_path):
    def write(name, lines):
        path = tmp_path / name
        path.write_text("\n".join(json.dumps(x) for x in lines))
        return str(path)

    return write


@pytest.fixture
def place(spark):
    return folders.work_folder(spark, "jobs-test")


def stories(ids):
    return [{"id": i, "type": "story" if i % 4 else "job", "title": f"t{i}", "score": i, "time": 1704067200} for i in ids]


def events(names, kind="PushEvent"):
    return [
        {"id": n, "type": kind, "actor": {"id": 1, "display_login": "a"}, "repo": {"name": "a/b"},
         "created_at": "2024-01-01T00:00:00Z", "payload": {"z": [1], "a": None}, "public": True}
        for n in names
    ]


def videos(names):
    return {
        "items": [
            {"id": n, "snippet": {"title": n, "channelTitle": "c", "publishedAt": "2024-01-01T00:00:00Z"},
             "statistics": {"viewCount": "9000000000"}, "contentDetails": {"duration": "PT2M"}}
            for n in names
        ]
    }


def search(names):
    return {"items": [{"id": {"videoId": n}} for n in names]}


def keys(spark, place):
    return [r["key"] for r in spark.read.parquet(f"{place}/replay").select(F.col("key").cast("string")).collect()]


def test_every_story_is_sent_once(spark, feed, place):
    items = feed("items", stories(range(1, 40)))
    deliver = jobs.to_replay(f"{place}/replay")

    def run(top, new, limit=None):
        lists = [feed("top", [top]), feed("new", [new])]
        return jobs.publish_stories(spark, lists, items, f"{place}/state", deliver, limit)

    assert run([9, 2], [2, 7]) == 3
    assert run([9, 2, 10], [11, 5]) == 3
    assert run([30, 31, 33], [17, 18], limit=2) == 2
    assert run([33, 31, 30], [18, 17]) == 3  # what the limit left out, though lower ids went first
    assert run([33, 31, 30], [18, 17]) == 0
    assert sorted(map(int, keys(spark, place))) == [2, 5, 7, 9, 10, 11, 17, 18, 30, 31, 33]


def test_events_skip_the_history(spark, feed, place):
    deliver = jobs.to_replay(f"{place}/replay")

    def run(*pages, limit=None):
        path = feed("pages", [{"page": n + 1, "events": p} for n, p in enumerate(pages)])
        return jobs.publish_events(spark, path, f"{place}/state", deliver, limit)

    assert run(events("ab"), events("bc"), limit=2) == 2
    assert run(events("abc")) == 1
    assert run(events("abc")) == 0
    assert run(events("d", "GollumEvent")) == 0
    assert sorted(keys(spark, place)) == ["a", "b", "c"]


def test_history_size(spark, feed, place):
    deliver = jobs.to_replay(f"{place}/replay")
    names = [f"{n:05d}" for n in range(1200)]
    pages = [{"page": n // 100 + 1, "events": events(names[n : n + 100])} for n in range(0, 1200, 100)]
    # A limit on pages is the caller's, and what it leaves out is sent by the next run.
    sent = jobs.publish_events(spark, feed("pages", pages), f"{place}/state", deliver, max_pages=10)
    assert sent == 1000
    again = [{"page": 1, "events": events(names)}]
    assert jobs.publish_events(spark, feed("pages", again), f"{place}/state", deliver) == 200
    assert state.read_history(spark, f"{place}/state/github").count() == 1200
    assert state.runs_since_compaction(spark, f"{place}/state/github") == 2
    more = [{"page": 1, "events": events(["x"])}]
    assert jobs.publish_events(spark, feed("pages", more), f"{place}/state", deliver, history_size=10) == 1
    kept = {r["key"] for r in state.read_history(spark, f"{place}/state/github").collect()}
    assert len(kept) == 10 and "x" in kept


def test_videos_once_per_run_and_history(spark, feed, place):
    deliver = jobs.to_replay(f"{place}/replay")
    details = feed("details", [videos(["v1", "v2"]), videos(["v2", "v3"])])

    def run(popular, found):
        paths = [feed(f"s{n}", [search(f)]) for n, f in enumerate(found)]
        return jobs.publish_videos(
            spark, feed("popular", [videos(popular)]), paths, details, f"{place}/state", deliver
        )

    assert run(["v1"], [["v1", "v2"], ["gone"]]) == 2
    assert run(["v1"], [["v3"]]) == 1
    assert sorted(keys(spark, place)) == ["v1", "v2", "v3"]


def test_end_to_end_from_the_command_line(spark, feed, place, capsys):
    state, replay, root = f"{place}/state", f"{place}/replay", f"{place}/lake"
    common = ["--state", state, "--replay", replay]
    lists = [feed("top", [[1, 2, 3]]), feed("new", [[3, 5, 8]])]
    assert main(["publish-stories", "--lists", *lists, "--items", feed("items", stories(range(1, 9))), *common]) == 0
    pages = feed("pages", [{"page": 1, "events": events("abc") + events("r", "ReleaseEvent")}])
    assert main(["publish-events", "--pages", pages, *common]) == 0
    popular = feed("popular", [videos(["v1", "v2"])])
    assert main(["publish-videos", "--popular", popular, "--details", popular, "--limit", "1", *common]) == 0
    assert [line for line in capsys.readouterr().out.splitlines() if line.startswith("published")] == [
        "published 4 messages", "published 4 messages", "published 1 messages",
    ]
    assert main(["ingest", "--replay", replay, "--root", root]) == 0
    assert main(["ingest", "--replay", replay, "--root", root]) == 0
    assert main(["audit", "--root", root]) == 0
    assert main(["silver", "--root", root]) == 0
    silver = jobs.read_silver(spark, root, "youtube").first()
    assert silver["view_count"] == 9000000000 and silver["duration_seconds"] == 120
    payload = {r["payload"] for r in jobs.read_silver(spark, root, "github").collect()}
    assert payload == {'{"z":[1],"a":null}'}
    # A release event is published but not allowed in silver: 26 of 27 rules hold.
    assert main(["check", "--root", root]) == 1
    stored = results.read_results(spark, f"{root}/quality")
    assert tuple(quality.tally(stored).first()) == (26, 1, False)
    failed = stored.where("NOT success").first()
    assert (failed["table"], failed["column"], failed["n_unexpected"]) == ("github_silver", "type", 1)


def test_unbuilt_silver_is_an_error(spark, place):
    with pytest.raises(ValueError, match="no finished version"):
        jobs.read_silver(spark, place, "github")


def test_store_options_come_from_the_command_line(monkeypatch):
    from tributary.__main__ import parser, store_options

    monkeypatch.setenv("MY_KEY", "k")
    monkeypatch.setenv("MY_SECRET", "s")
    line = "silver --root s3a://lake --store-endpoint http://host:9000 --store-access-key-variable MY_KEY"
    args = parser().parse_args([*line.split(), "--store-secret-key-variable", "MY_SECRET"])
    options = store_options(args)
    assert options["spark.hadoop.fs.s3a.endpoint"] == "http://host:9000"
    assert options["spark.hadoop.fs.s3a.access.key"] == "k" and options["spark.hadoop.fs.s3a.secret.key"] == "s"
    assert store_options(parser().parse_args("silver --root x".split())) is None


def test_unreadable_lines_are_kept(spark, feed, place, tmp_path):
    path = tmp_path / "items"
    path.write_text(json.dumps(stories([1])[0]) + "\ngarbage\n")
    sent = jobs.publish_stories(spark, [feed("top", [[1, 2]])], str(path), f"{place}/state", jobs.to_replay(f"{place}/replay"))
    assert sent == 1
    aside = spark.read.parquet(f"{place}/state/quarantine").collect()
    assert [(r["kind"], r["raw_json"], r["reason"]) for r in aside] == [("story_item", "garbage", "malformed")]


def test_newest_copy_of_a_batch_is_in_silver(spark, feed, place):
    """Copies sent by two runs and landed in one batch; then a third that only the second build reads."""
    deliver = jobs.to_replay(f"{place}/replay")

    def run(score):
        items = feed("items", [{**s, "score": score} for s in stories([1, 2, 3, 5])])
        return jobs.publish_stories(spark, [feed("top", [[1, 2, 3, 5]])], items, f"{place}/state{score}", deliver)

    assert run(1) == run(2) == 4
    jobs.land_available(jobs.replay_streams(spark, f"{place}/replay"), f"{place}/lake")
    jobs.build_silver(spark, f"{place}/lake", "hackernews")
    scores = lambda: {r["score"] for r in jobs.read_silver(spark, f"{place}/lake", "hackernews").collect()}
    assert scores() == {2}
    run(3)
    jobs.land_available(jobs.replay_streams(spark, f"{place}/replay"), f"{place}/lake")
    jobs.build_silver(spark, f"{place}/lake", "hackernews")
    assert scores() == {3} and jobs.read_silver(spark, f"{place}/lake", "hackernews").count() == 4


def lines_of(tmp_path, name, texts):
    path = tmp_path / name
    path.write_text("\n".join(texts))
    return str(path)


def test_elements_are_judged_one_by_one(spark, feed, place, tmp_path):
    good = events("ab")
    broken = [None, 7, {"type": "PushEvent"}, {"id": "x", "actor": [1]}]
    lines = [
        json.dumps({"page": 1, "events": [good[0], *broken, good[1]]}),
        json.dumps({"error": "rate limit"}),
        json.dumps({"page": 2, "events": {}}),
        json.dumps({"page": 3, "events": []}),
        "null", "", "garbage",
    ]
    pages = lines_of(tmp_path, "pages", lines)
    assert jobs.publish_events(spark, pages, f"{place}/state", jobs.to_replay(f"{place}/replay")) == 2
    aside = jobs.read_quarantine(spark, f"{place}/state").orderBy("line", "pos").collect()
    assert [(r.pos, r.reason) for r in aside] == [
        (1, "null element"), (2, "unexpected shape"), (3, "missing key"), (4, "misfit"),
        (None, "error response"), (None, "unexpected shape"), (None, "malformed"), (None, "malformed"),
    ]
    assert json.loads(aside[3].raw_json) == broken[3]


def test_ids_of_a_list_are_numbers(spark, feed, place, tmp_path):
    lists = [lines_of(tmp_path, "top", ['[3, "4", null, 1.5, {"id": 2}, 1]'])]
    items = feed("items", [*stories([1, 2, 3]), {"title": "no id"}, None, {**stories([3])[0], "title": "later"}])
    sent = jobs.publish_stories(spark, lists, items, f"{place}/state", jobs.to_replay(f"{place}/replay"))
    assert sent == 2  # id 3 was fetched twice
    titles = spark.read.parquet(f"{place}/replay").select(F.get_json_object(F.col("value").cast("string"), "$.title"))
    assert sorted(r[0] for r in titles.collect()) == ["later", "t1"]
    reasons = [r.reason for r in jobs.read_quarantine(spark, f"{place}/state").orderBy("path", "line", "pos").collect()]
    assert reasons == ["missing key", "unexpected shape", "null element", "unexpected shape", "unexpected shape"]


@pytest.mark.parametrize("dies", ["before", "after"])
def test_a_run_that_died_is_finished_by_the_next(spark, feed, place, dies):
    replay = jobs.to_replay(f"{place}/replay")

    def failing(records, run):
        if dies == "after":
            replay(records, run)
        raise RuntimeError("lost")

    def run(ids, deliver):
        items = feed("items", stories([1, 2, 3, 5]))
        return jobs.publish_stories(spark, [feed("top", [ids])], items, f"{place}/state", deliver)

    with pytest.raises(RuntimeError):
        run([1, 2], failing)
    assert state.read_history(spark, f"{place}/state/hackernews").count() == 0
    assert run([2, 3], replay) == 1  # 1 and 2 go out under the dead run's name first
    assert run([1, 2, 3, 5], replay) == 1
    assert sorted(map(int, keys(spark, place))) == [1, 2, 3, 5]


def test_a_first_run_that_died_blocks_nothing(spark, feed, place):
    """Folders without a mark, of a history, an outbox and a silver table."""
    for base in ("state/hackernews/run=1+", "state/outbox/hackernews/run=1", "lake/silver/hackernews_silver/run=1"):
        spark.range(1).write.parquet(f"{place}/{base}/rows")
    deliver = jobs.to_replay(f"{place}/replay")
    items = feed("items", stories([1, 2, 3]))
    assert jobs.publish_stories(spark, [feed("top", [[1, 2, 3]])], items, f"{place}/state", deliver) == 3
    jobs.land_available(jobs.replay_streams(spark, f"{place}/replay"), f"{place}/lake")
    jobs.build_silver(spark, f"{place}/lake", "hackernews")
    assert jobs.read_silver(spark, f"{place}/lake", "hackernews").count() == 3


def records(spark, texts):
    rows = [(f"k{i}".encode(), t.encode(), i) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "key BINARY, value BINARY, offset BIGINT")
    return frame.selectExpr("key", "value", "'hackernews-posts' AS topic", "0 AS partition", "offset",
                            "timestamp'2024-01-01' AS timestamp", "0 AS timestampType")


def land_texts(spark, place, texts):
    records(spark, texts).write.mode("append").parquet(f"{place}/topic")
    stream = spark.readStream.schema(KAFKA_RECORD).parquet(f"{place}/topic")
    jobs.land_available({"hackernews": stream}, f"{place}/lake")


def test_silver_before_the_first_good_row(spark, place):
    land_texts(spark, place, ["broken"])
    for source in ("hackernews", "github", "youtube"):  # two never landed at all
        jobs.build_silver(spark, f"{place}/lake", source)
        assert jobs.read_silver(spark, f"{place}/lake", source).count() == 0
    checked = jobs.check_silver(spark, f"{place}/lake")
    assert checked.count() > 0 and checked.where("n_unexpected > 0").count() == 0
    land_texts(spark, place, [json.dumps(s) for s in stories([1, 2])])
    jobs.build_silver(spark, f"{place}/lake", "hackernews")
    assert jobs.read_silver(spark, f"{place}/lake", "hackernews").count() == 2


def test_untouched_dates_keep_their_files(spark, place):
    lake, day = f"{place}/lake", 86400

    def story(i, at, score=1):
        return json.dumps({"id": i, "type": "story", "title": "t", "score": score, "time": 1704067200 + at * day})

    def files():
        silver = jobs.read_silver(spark, lake, "hackernews")
        rows = silver.select("id", "score", F.col("event_date").cast("string"), F.col("_metadata.file_path").alias("file")).collect()
        return {r.id: (r.score, r.event_date, r.file) for r in rows}

    land_texts(spark, place, [story(i, i % 4) for i in range(12)])
    jobs.build_silver(spark, lake, "hackernews")
    first = files()
    # one row of the first day is replaced, one moves from the second day to a new one
    land_texts(spark, place, [story(0, 0, score=5), story(1, 9)])
    jobs.build_silver(spark, lake, "hackernews")
    second = files()
    assert len(second) == 12 and second[0][0] == 5 and second[1][1] == "2024-01-10"
    for i in range(12):
        same = second[i][2] == first[i][2]
        assert same == (i % 4 in (2, 3)), i
    assert jobs.build_silver(spark, lake, "hackernews") and files() == second  # nothing new, nothing written
    jobs.build_silver(spark, lake, "hackernews", full=True)
    assert {i: r[:2] for i, r in files().items()} == {i: r[:2] for i, r in second.items()}


def test_compaction_rewrites_new_dates_only(spark, place):
    lake = f"{place}/lake"
    ingest_at = lambda day: F.lit(f"2024-01-0{day} 12:00:00").cast("timestamp")
    for day in (3, 2, 2):  # the second batch is earlier than the first
        records(spark, [json.dumps(s) for s in stories([day])]).write.mode("append").parquet(f"{place}/topic")
        stream = spark.readStream.schema(KAFKA_RECORD).parquet(f"{place}/topic")
        ingest.drain([ingest.start_bronze(stream, "hackernews", lake, ingest.ONCE, at=ingest_at(day))])
        version = compact(spark, lake, "hackernews")
        assert bronze.read(spark, lake, "hackernews").count() == bronze.read_leaf(spark, bronze.leaf_path(lake, "hackernews")).count()
    named = dated.folders_of(spark, version)
    assert sorted(n.split("=")[-1] for n in named) == ["2024-01-02", "2024-01-03"]
    assert len({n.split("/")[0] for n in named}) == 2 and bronze.read(spark, lake, "hackernews").count() == 3


def test_commit_log_goes_on_over_its_own_compaction(spark, place, changed):
    changed(**{"spark__sql__streaming__fileSink__log__compactInterval": "3", "spark__sql__streaming__fileSink__log__cleanupDelay": "1"})
    lake, version = f"{place}/lake", None
    for i in range(8):
        land_texts(spark, place, [json.dumps(s) for s in stories([i + 1])])
        tail = bronze.since(spark, lake, "hackernews", version)
        new = 1 if version else i + 1
        assert tail.batch == i and tail.files.count() == i + 1 and tail.rows.count() == new
        if i % 2:
            version = jobs.build_silver(spark, lake, "hackernews")
        else:
            version = None
    assert jobs.read_silver(spark, lake, "hackernews").count() == 8
