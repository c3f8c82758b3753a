"""Whole runs over stored data: publish, land, conform, check, audit.

Each job stores what it computed before anything is derived from it, so a count, a
delivery and a state write all see the same rows, whatever was lost and run again.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary import dated, folders, schemas
from tributary.functions.times import run_name_at
from tributary.operators import audit, conform, feeds, publish, quality, results, rules, state
from tributary.operators.normalize import normalize_video
from tributary.sources import bronze, definitions, kafka, landed
from tributary.streaming import ingest

# Sends the records of a run; the name of the run is the same when a dead run is repeated.
Deliver = Callable[[DataFrame, str], None]


# --- publish ----------------------------------------------------------------


def to_broker(bootstrap: str) -> Deliver:
    """To a broker, where a repeated run is sent again with the same keys."""
    return lambda records, run: publish.write_topic(records, bootstrap)


def to_replay(folder: str) -> Deliver:
    """Append the records as Parquet in the broker's schema, a folder per topic, for a run without a broker.

    A run that is there already is not written again.
    """

    def deliver(records: DataFrame, run: str) -> None:
        spark, mark = records.sparkSession, f"{folder}/_delivered/run={run}"
        if folders.is_finished(spark, mark):
            return
        unknown = F.lit(None)
        shaped = kafka.records(
            records, "key", F.col("value"), F.col("topic"), unknown, unknown
        )
        shaped.write.mode("append").partitionBy("topic").parquet(folder)
        folders.finish(spark, mark)

    return deliver


def publish_stories(
    spark: SparkSession,
    lists: list[str],
    items: str,
    state_root: str,
    deliver: Deliver,
    limit: int | None = None,
    text_length: int | None = None,
) -> int:
    """Ranked id lists, in the order given, and fetched items; returns how many were sent.

    The state holds every id sent. What a limit leaves out, or an item that was not fetched,
    is sent by a later run that finds it. Of an item fetched twice the later copy counts.
    """
    outbox = Outbox(spark, "hackernews", state_root, deliver)
    ranked = feeds.union_feeds([outbox.elements(path, "story_list").select("pos", "id") for path in lists])
    fetched = outbox.elements(items, "story_item").drop("page", "pos")
    messages = feeds.story_feed(
        ranked,
        feeds.newest_items(fetched, "id", "line"),
        ["list_rank", "pos"],
        history=outbox.history(),
        limit=limit,
        text_length=text_length,
    )
    return outbox.send(messages)


def publish_events(
    spark: SparkSession,
    pages: str,
    state_root: str,
    deliver: Deliver,
    limit: int | None = None,
    history_size: int | None = None,
    max_pages: int | None = None,
    rows_per_page: int | None = None,
) -> int:
    """Event pages as lines `{"page": n, "events": [...]}`; returns how many were sent.

    All pages are taken and the state keeps every id published, unless a size bounds them.
    """
    outbox = Outbox(spark, "github", state_root, deliver, history_size)
    messages = feeds.event_feed(
        outbox.elements(pages, "numbered_event_page").drop("line"), ["page", "pos"], history=outbox.history(),
        limit=limit, max_pages=max_pages, rows_per_page=rows_per_page,
    )
    return outbox.send(messages)


def publish_videos(
    spark: SparkSession,
    popular: str,
    searches: list[str],
    details: str,
    state_root: str,
    deliver: Deliver,
    limit: int | None = None,
    history_size: int | None = None,
    text_length: int | None = None,
) -> int:
    """The popular envelope, search results in query order, and the details of both."""
    outbox = Outbox(spark, "youtube", state_root, deliver, history_size)
    first = outbox.elements(popular, "video_envelope").select("pos", "id")
    found = [
        outbox.elements(path, "search_envelope").select("pos", F.col("id.videoId").alias("id")) for path in searches
    ]
    ranked = feeds.union_feeds([first, *found])
    known = normalize_video(outbox.elements(details, "video_envelope"), "pos", "line", text_length=text_length)
    known = feeds.newest_items(known.drop("pos"), "video_id", "line")
    messages = feeds.video_feed(
        ranked.where("list_rank = 0"), ranked.where("list_rank > 0"), known,
        history=outbox.history(), limit=limit,
    )
    return outbox.send(messages)


COMMITTED = "_COMMITTED"


class Outbox:
    """One run of publishing: what it reads, what it sends and what it remembers.

    A run first writes its messages and a mark, its intent, then delivers them, appends their ids to the
    history and is committed. A run that died after its intent is finished by the next one before that reads
    the history: the same messages under the same run name, whatever the feeds hold by then. One that died earlier
    has sent nothing.
    """

    def __init__(
        self, spark: SparkSession, source: str, state_root: str, deliver: Deliver, history_size: int | None = None
    ):
        self.spark, self.source, self.deliver, self.size = spark, source, deliver, history_size
        self.root = state_root.rstrip("/")
        self.run, self.read = state.run_stamp(), 0
        for name in folders.children(spark, f"{self.root}/outbox/{source}"):
            path = f"{self.root}/outbox/{source}/{name}"
            if folders.is_finished(spark, path) and not folders.exists(spark, f"{path}/{COMMITTED}"):
                self._complete(path, name.removeprefix("run="))

    def elements(self, path: str, kind: str) -> DataFrame:
        """(line, page, pos, fields) of the good elements of a landed file; the others are kept below the state.

        The file is read and judged once; `line` tells later responses from earlier ones.
        """
        stored = folders.work_folder(self.spark, f"landed-{kind}")
        lines = landed.read_lines(self.spark, path).withColumn("line", F.monotonically_increasing_id())
        judged = landed.elements(lines, kind, "line")
        judged.write.parquet(stored)
        judged = self.spark.read.schema(judged.schema).parquet(stored)
        aside = f"{self.root}/quarantine/run={self.run}-{self.source}-{self.read}"
        self.read += 1
        bad = landed.bad_elements(judged, kind, "line")
        bad.withColumns({"path": F.lit(path), "seen_at": F.current_timestamp()}).write.parquet(aside)
        folders.finish(self.spark, aside)
        return landed.good_elements(judged, "line", "page", "pos")

    def history(self) -> DataFrame:
        return state.read_history(self.spark, f"{self.root}/{self.source}")

    def send(self, messages: DataFrame) -> int:
        path = f"{self.root}/outbox/{self.source}/run={self.run}"
        messages.write.parquet(f"{path}/messages")
        folders.finish(self.spark, path)
        return self._complete(path, self.run)

    def _complete(self, path: str, run: str) -> int:
        sent = self.spark.read.parquet(f"{path}/messages")
        self.deliver(publish.to_kafka_records(sent, self.source), f"{self.source}-{run}")
        seen = feeds.seen_now(sent, self.source, schemas.source(self.source).key, F.current_timestamp())
        history = f"{self.root}/{self.source}"
        state.append_history(seen, history, run)
        if self.size or state.runs_since_compaction(self.spark, history) >= state.COMPACT_AFTER:
            known = feeds.each_once(state.read_history(self.spark, history))
            state.save_history(feeds.bounded_history(known, self.size) if self.size else known, history)
        folders.touch(self.spark, f"{path}/{COMMITTED}")
        return sent.count()


def read_quarantine(spark: SparkSession, state_root: str) -> DataFrame:
    """(kind, pos, raw_json, reason, path, seen_at, line) of what finished reads put aside."""
    columns = "line BIGINT, kind STRING, pos INT, raw_json STRING, reason STRING, path STRING, seen_at TIMESTAMP"
    paths = folders.finished_versions(spark, f"{state_root.rstrip('/')}/quarantine")
    return spark.read.schema(columns).parquet(*paths) if paths else spark.createDataFrame([], columns)


# --- land -------------------------------------------------------------------


def topic_streams(
    spark: SparkSession, bootstrap: str, max_offsets_per_trigger: int = 10_000_000, **options
) -> dict[str, DataFrame]:
    """A stream per topic; a backlog is read in batches of at most so many records."""
    return {
        s.name: kafka.read_topic(
            spark, bootstrap, s.topic, max_offsets_per_trigger=max_offsets_per_trigger, **options
        )
        for s in schemas.SOURCES.values()
    }


def replay_streams(
    spark: SparkSession, folder: str, max_files_per_trigger: int = 1000
) -> dict[str, DataFrame]:
    """The records of a replay folder, each source from its own topic's part, in bounded batches.

    A topic without any record yet is left out.
    """
    streams = {}
    for s in schemas.SOURCES.values():
        path = f"{folder.rstrip('/')}/topic={s.topic}"
        if folders.exists(spark, path):
            reader = spark.readStream.schema(schemas.KAFKA_RECORD.replace("topic STRING, ", ""))
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
            streams[s.name] = reader.parquet(path).withColumn("topic", F.lit(s.topic))
    return streams


def land(
    spark: SparkSession, streams: dict[str, DataFrame], root: str, duration: int | None = None
) -> None:
    """Run until stopped, or for `duration` seconds."""
    ingest.ingest(spark, streams, root, duration=duration)


def land_available(streams: dict[str, DataFrame], root: str) -> None:
    """Land what is there and end."""
    ingest.drain(ingest.start_all(streams, root, ingest.ONCE))


# --- conform and check ------------------------------------------------------


def build_silver(spark: SparkSession, root: str, source: str, full: bool = False) -> str:
    """Write a new version of a silver table; readers see it once it is complete.

    After the first version only files committed since are read, parsed and ranked. The table is partitioned
    by the date of the event, and only dates that get a row or lose one to a newer copy are written
    again; of the stored rows of other dates the build reads just the keys. `full` starts over. A source without a
    good row gives an empty table.
    """
    base, run = _silver_base(root, source), state.run_stamp()
    before = None if full else folders.newest_version(spark, base)
    tail = bronze.since(spark, root, source, before)
    stored = folders.work_folder(spark, f"silver-{source}")
    conform.silver_rows(bronze.good(tail.rows), source).write.parquet(stored)
    fresh = spark.read.schema(conform.silver_schema(spark, source)).parquet(stored)
    touched, rows = dated.dates(fresh, DATE), fresh
    if before:
        touched |= dated.dates(conform.replaced(_silver(spark, base, before, source), fresh, source), DATE)
        rows = conform.silver_update(_silver(spark, base, before, source, touched), fresh, source)
    path = dated.write(spark, base, run, rows, DATE, touched, before)
    tail.files.write.parquet(f"{path}/files")
    folders.finish(spark, path)
    return path


DATE = "event_date"


def _silver_base(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/silver/{schemas.source(source).name}_silver"


def _silver(spark: SparkSession, base: str, version: str, source: str, only: set[str] | None = None) -> DataFrame:
    return dated.read(spark, base, version, conform.silver_schema(spark, source), DATE, only)


def read_silver(spark: SparkSession, root: str, source: str) -> DataFrame:
    base = _silver_base(root, source)
    newest = folders.newest_version(spark, base)
    if newest is None:
        raise ValueError(f"no finished version below {base}")
    return _silver(spark, base, newest, source)


def check_silver(
    spark: SparkSession,
    root: str,
    moment: datetime | None = None,
    suites: str | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """Run the checkpoint over the silver tables, store its results and return them.

    `suites` and `checkpoint` are paths of JSON documents that replace the built-in rules, and
    the pairs and the run name that go with them.
    """
    moment = moment or datetime.now(timezone.utc)
    run = definitions.read_run_name(spark, checkpoint, moment) if checkpoint else run_name_at(moment)
    pairs = definitions.read_validations(spark, checkpoint) if checkpoint else rules.VALIDATIONS
    known = definitions.read_suites(spark, suites) if suites else rules.SUITES
    tables = {f"{s}_silver": read_silver(spark, root, s) for s in schemas.SOURCES}
    checked = quality.run_checkpoint(tables, known, pairs, run)
    return results.store_results(checked, f"{root.rstrip('/')}/quality", run)


def audit_landing(spark: SparkSession, root: str) -> DataFrame:
    """Files, rows and message columns of every source, as passed or failed checks."""
    required = {s.name: s.schema.names for s in schemas.SOURCES.values()}
    return audit.landing_checks(audit.landing_audit(spark, root, required))
