"""Quality rules, suites, the checkpoint and its stored results."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary import folders
from tributary.operators import conform, quality, results, rules
from tributary.operators.rules import Rule, Suite
from tributary.plans import inputs
from tributary.plans.feeds import EVENT_FIELDS_SQL
from tributary.plans.registry import register
from tributary.sources import definitions
from tributary.sources.tables import table


def rule_sql(
    suite: str, table_name: str, idx: int, kind: str, column: str, source: str, n_unexpected: str,
    fits: str = "true",
) -> str:
    """One result row; `n_unexpected` is an aggregate over `source`."""
    return (
        f"SELECT '{suite}' AS suite, '{table_name}' AS \"table\", {idx} AS idx, '{kind}' AS rule, "
        f"'{column}' AS \"column\", count(*) AS n_rows, "
        f"CAST({n_unexpected} AS BIGINT) AS n_unexpected, ({n_unexpected}) = 0 AND {fits} AS success "
        f"FROM {source}"
    )


def suite_sql(suite: str, table_name: str, source: str, checks: list[tuple]) -> str:
    return " UNION ALL ".join(
        rule_sql(suite, table_name, idx, kind, column, source, *rest)
        for idx, (kind, column, *rest) in enumerate(checks)
    )


def repeated_sql(column: str, source: str) -> str:
    return (
        f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {source} "
        f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1))"
    )


# --- single rules -----------------------------------------------------------


@register(
    "dq_column_exists",
    suite_sql(
        "exists", "orders", "orders",
        [(rules.EXISTS, "o_orderkey", "0"), (rules.EXISTS, "o_clerk", "count(*)", "false")],
    ),
)
def dq_column_exists(spark: SparkSession, folder: str) -> DataFrame:
    suite = Suite("exists", (Rule(rules.EXISTS, "o_orderkey"), Rule(rules.EXISTS, "o_clerk")))
    return quality.run_suite(table(spark, folder, "orders"), suite, "orders")


LABELLED_SQL = "(SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


@register(
    "dq_not_null",
    suite_sql(
        "not_null", "labelled", LABELLED_SQL,
        [(rules.NOT_NULL, "doc_id", "0"),
         (rules.NOT_NULL, "quality", "count(*) FILTER (quality IS NULL)")],
    ),
)
def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    labelled = table(spark, folder, "documents").select("doc_id").join(labels, "doc_id", "left")
    suite = Suite("not_null", (Rule(rules.NOT_NULL, "doc_id"), Rule(rules.NOT_NULL, "quality")))
    return quality.run_suite(labelled, suite, "labelled")


@register(
    "dq_unique",
    suite_sql(
        "unique", "lineitem", "lineitem",
        [(rules.UNIQUE, "l_orderkey", repeated_sql("l_orderkey", "lineitem")),
         (rules.UNIQUE, "l_suppkey", repeated_sql("l_suppkey", "lineitem"))],
    ),
)
def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    suite = Suite("unique", (Rule(rules.UNIQUE, "l_orderkey"), Rule(rules.UNIQUE, "l_suppkey")))
    return quality.run_suite(table(spark, folder, "lineitem"), suite, "lineitem")


@register(
    "dq_between",
    suite_sql(
        "between", "lineitem", "lineitem",
        [(rules.BETWEEN, "l_quantity", "count(*) FILTER (l_quantity < 5 OR l_quantity > 45)"),
         (rules.BETWEEN, "l_discount", "count(*) FILTER (l_discount < 0)")],
    ),
)
def dq_between(spark: SparkSession, folder: str) -> DataFrame:
    suite = Suite(
        "between",
        (Rule(rules.BETWEEN, "l_quantity", low=5, high=45), Rule(rules.BETWEEN, "l_discount", low=0)),
    )
    return quality.run_suite(table(spark, folder, "lineitem"), suite, "lineitem")


@register(
    "dq_in_set",
    suite_sql(
        "in_set", "events", "events",
        [(rules.IN_SET, "event_type", "count(*) FILTER (event_type NOT IN ('click', 'view'))")],
    ),
)
def dq_in_set(spark: SparkSession, folder: str) -> DataFrame:
    suite = quality.single_rule("in_set", rules.IN_SET, "event_type", allowed=("click", "view"))
    return quality.run_suite(table(spark, folder, "events"), suite, "events")


@register(
    "dq_of_type",
    suite_sql(
        "of_type", "events", "events",
        [(rules.OF_TYPE, "ts", "0"), (rules.OF_TYPE, "user_id", "0"),
         (rules.OF_TYPE, "props", "count(*)", "false")],
    ),
)
def dq_of_type(spark: SparkSession, folder: str) -> DataFrame:
    suite = Suite(
        "of_type",
        (
            Rule(rules.OF_TYPE, "ts", family="TIMESTAMP"),
            Rule(rules.OF_TYPE, "user_id", family="INTEGER"),
            Rule(rules.OF_TYPE, "props", family="INTEGER"),
        ),
    )
    return quality.run_suite(table(spark, folder, "events"), suite, "events")


# --- the three suites over silver -------------------------------------------


def silver(spark: SparkSession, folder: str, source: str) -> DataFrame:
    """A stored silver table: rules that need a scan of their own read columns, not JSON."""
    path = f"{folders.work_folder(spark, 'silver')}/{source}_silver"
    conform.CONFORM[source](inputs.bronze_of(spark, folder, source)).write.parquet(path)
    return spark.read.parquet(path)


EVENT_SILVER_SQL = f"(SELECT {EVENT_FIELDS_SQL} FROM events)"
EVENT_ALLOWED_SQL = ", ".join(f"'{t}'" for t in rules.EVENT_SUITE.rules[7].allowed)
STORY_CHECKS_SQL = suite_sql(
    "hackernews_expectations", "hackernews_silver", "documents",
    [(rules.NOT_NULL, "id", "0"),
     (rules.UNIQUE, "id", repeated_sql("doc_id", "documents")),
     (rules.NOT_NULL, "title", "0"),
     (rules.BETWEEN, "score", "count(*) FILTER (n_chars < 0)"),
     (rules.OF_TYPE, "time", "0"),
     (rules.IN_SET, "type", "0")],
)
EVENT_CHECKS_SQL = suite_sql(
    "github_expectations", "github_silver", EVENT_SILVER_SQL,
    [(rules.EXISTS, "id", "0"), (rules.EXISTS, "type", "0"), (rules.EXISTS, "created_at", "0"),
     (rules.EXISTS, "actor_login", "0"), (rules.EXISTS, "repo_name", "0"),
     (rules.NOT_NULL, "id", "count(*) FILTER (id IS NULL)"),
     (rules.UNIQUE, "id", repeated_sql("id", EVENT_SILVER_SQL)),
     (rules.IN_SET, "type", f"count(*) FILTER (type NOT IN ({EVENT_ALLOWED_SQL}))"),
     (rules.OF_TYPE, "created_at", "0")],
)
VIDEO_CHECKS_SQL = suite_sql(
    "youtube_expectations", "youtube_silver", "pages",
    [(rules.EXISTS, "video_id", "0"), (rules.EXISTS, "title", "0"), (rules.EXISTS, "view_count", "0"),
     (rules.EXISTS, "like_count", "0"), (rules.EXISTS, "published_at", "0"),
     (rules.EXISTS, "channel_title", "0"), (rules.NOT_NULL, "video_id", "0"),
     (rules.NOT_NULL, "title", "0"), (rules.UNIQUE, "video_id", repeated_sql("page_id", "pages")),
     (rules.BETWEEN, "view_count",
      "count(*) FILTER (CAST(length(html) AS BIGINT) * 1000000 > 10000000000)"),
     (rules.BETWEEN, "like_count", "0"), (rules.OF_TYPE, "published_at", "0")],
)


@register("dq_suite_story", STORY_CHECKS_SQL)
def dq_suite_story(spark: SparkSession, folder: str) -> DataFrame:
    return quality.run_suite(
        silver(spark, folder, "hackernews"), rules.STORY_SUITE, "hackernews_silver"
    )


@register("dq_suite_event", EVENT_CHECKS_SQL)
def dq_suite_event(spark: SparkSession, folder: str) -> DataFrame:
    return quality.run_suite(silver(spark, folder, "github"), rules.EVENT_SUITE, "github_silver")


@register("dq_suite_video", VIDEO_CHECKS_SQL)
def dq_suite_video(spark: SparkSession, folder: str) -> DataFrame:
    return quality.run_suite(silver(spark, folder, "youtube"), rules.VIDEO_SUITE, "youtube_silver")


def silver_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The three tables, stored at the same time."""
    with ThreadPoolExecutor(len(inputs.MESSAGES)) as pool:
        stored = pool.map(lambda source: silver(spark, folder, source), inputs.MESSAGES)
        return {f"{source}_silver": frame for source, frame in zip(inputs.MESSAGES, stored)}


CHECKPOINT_SQL = f"{STORY_CHECKS_SQL} UNION ALL {EVENT_CHECKS_SQL} UNION ALL {VIDEO_CHECKS_SQL}"


@register("dq_checkpoint", CHECKPOINT_SQL)
def dq_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    """Runs the checkpoint, stores its results, and reads them back."""
    run = "20240101-000000-bronze-to-silver-validation"
    checked = quality.run_checkpoint(
        silver_tables(spark, folder), rules.SUITES, rules.VALIDATIONS, run
    )
    store = folders.work_folder(spark, "quality")
    results.store_results(checked, store, run)
    return results.read_results(spark, store).drop("run", "run_name")


@register(
    "dq_evaluation_parameters",
    "SELECT suite, idx, metric, value FROM (SELECT suite, idx, n_rows, n_unexpected FROM "
    f"({EVENT_CHECKS_SQL})) UNPIVOT (value FOR metric IN (n_rows, n_unexpected))",
)
def dq_evaluation_parameters(spark: SparkSession, folder: str) -> DataFrame:
    checked = quality.run_checkpoint(
        {"github_silver": silver(spark, folder, "github")},
        rules.SUITES,
        [("github_silver", "github_expectations")],
        "run",
    )
    return quality.evaluation_parameters(checked).select("suite", "idx", "metric", "value")


@register(
    "audit_summary",
    'SELECT "table", count(*) FILTER (success) AS passed, count(*) FILTER (NOT success) AS failed, '
    f'bool_and(success) AS success FROM ({CHECKPOINT_SQL}) GROUP BY "table"',
)
def audit_summary(spark: SparkSession, folder: str) -> DataFrame:
    checked = quality.run_checkpoint(silver_tables(spark, folder), rules.SUITES, rules.VALIDATIONS)
    return quality.tally(checked, "table")


@register(
    "dq_row_tags",
    "SELECT l_orderkey, l_linenumber, concat_ws(',', "
    "CASE WHEN l_quantity < 5 OR l_quantity > 45 THEN "
    "'expect_column_values_to_be_between:l_quantity' END, "
    "CASE WHEN l_returnflag NOT IN ('A', 'N') THEN "
    "'expect_column_values_to_be_in_set:l_returnflag' END) AS failures FROM lineitem",
)
def dq_row_tags(spark: SparkSession, folder: str) -> DataFrame:
    suite = Suite(
        "lines",
        (
            Rule(rules.NOT_NULL, "l_orderkey"),
            Rule(rules.BETWEEN, "l_quantity", low=5, high=45),
            Rule(rules.IN_SET, "l_returnflag", allowed=("A", "N")),
        ),
    )
    tagged = quality.row_tags(table(spark, folder, "lineitem"), suite)
    return tagged.select(
        "l_orderkey", "l_linenumber", F.array_join("dq_failures", ",").alias("failures")
    )


# --- suites and a checkpoint from documents ---------------------------------

LINE_RULES = [
    {"expectation_type": rules.NOT_NULL, "kwargs": {"column": "l_orderkey"}},
    {"expectation_type": rules.BETWEEN, "kwargs": {"column": "l_discount", "min_value": 0.025, "max_value": 10}},
    {"expectation_type": rules.IN_SET, "kwargs": {"column": "l_returnflag", "value_set": ["A", "N"]}},
    {"expectation_type": rules.OF_TYPE, "kwargs": {"column": "l_shipdate", "type_": "TIMESTAMP"}},
]
LINE_CHECKS_SQL = suite_sql(
    "lines", "lineitem", "lineitem",
    [(rules.NOT_NULL, "l_orderkey", "count(*) FILTER (l_orderkey IS NULL)"),
     (rules.BETWEEN, "l_discount", "count(*) FILTER (l_discount < 0.025 OR l_discount > 10)"),
     (rules.IN_SET, "l_returnflag", "count(*) FILTER (l_returnflag NOT IN ('A', 'N'))"),
     (rules.OF_TYPE, "l_shipdate", "0")],
)


def document(spark: SparkSession, content: dict) -> str:
    """A JSON document in a work folder."""
    path = folders.work_folder(spark, "definitions")
    spark.createDataFrame([(json.dumps(content),)], "value STRING").coalesce(1).write.text(path)
    return path


@register("dq_suite_from_json", LINE_CHECKS_SQL)
def dq_suite_from_json(spark: SparkSession, folder: str) -> DataFrame:
    """Rules read from a document, one with a fractional bound."""
    path = document(spark, {"expectation_suite_name": "lines", "expectations": LINE_RULES})
    suite = definitions.read_suites(spark, path)["lines"]
    return quality.run_suite(table(spark, folder, "lineitem"), suite, "lineitem")


@register(
    "dq_checkpoint_from_json",
    "SELECT run_name, suite, idx, metric, value FROM (SELECT '20240101-lines' AS run_name, suite, idx, n_rows, "
    f"n_unexpected FROM ({LINE_CHECKS_SQL})) UNPIVOT (value FOR metric IN (n_rows, n_unexpected))",
)
def dq_checkpoint_from_json(spark: SparkSession, folder: str) -> DataFrame:
    """Suite, pairs and run name from documents; the stored parameters are read back."""
    suites = document(spark, {"expectation_suite_name": "lines", "expectations": LINE_RULES})
    checkpoint = document(
        spark,
        {
            "name": "lines", "run_name_template": "%Y%m%d-lines",
            "validations": [
                {"batch_request": {"data_asset_name": "lineitem"}, "expectation_suite_name": "lines"}
            ],
        },
    )
    run = definitions.read_run_name(spark, checkpoint, datetime(2024, 1, 1))
    tables = {"lineitem": table(spark, folder, "lineitem")}
    checked = quality.run_checkpoint(
        tables, definitions.read_suites(spark, suites), definitions.read_validations(spark, checkpoint), run
    )
    store = folders.work_folder(spark, "quality")
    results.store_results(checked, store, run)
    return results.read_parameters(spark, store).select("run_name", "suite", "idx", "metric", "value")
