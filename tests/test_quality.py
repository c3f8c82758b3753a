from __future__ import annotations

import json
from collections import Counter
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tributary import folders
from tributary.operators import quality, results, rules
from tributary.operators.rules import Rule, Suite
from tributary.sources import definitions

SCHEMA = "k STRING, v STRING, n BIGINT, t TIMESTAMP"
NOW = datetime(2024, 1, 1)
ROWS = [("a", "a", 1, NOW), ("a", "z", 11, NOW), ("b", None, None, None), (None, "a", 5, NOW), (None, "b", -1, NOW)]


def outcome(spark, rule, rows=ROWS, schema=SCHEMA):
    frame = spark.createDataFrame(rows, schema)
    row = quality.run_suite(frame, Suite("s", (rule,)), "t").first()
    return row["n_rows"], row["n_unexpected"], row["success"]


@pytest.mark.parametrize(
    ("rule", "expected"),
    [
        (Rule(rules.EXISTS, "k"), (5, 0, True)),
        (Rule(rules.EXISTS, "gone"), (5, 5, False)),
        (Rule(rules.NOT_NULL, "k"), (5, 2, False)),
        (Rule(rules.NOT_NULL, "gone"), (5, 5, False)),
        (Rule(rules.UNIQUE, "k"), (5, 2, False)),
        (Rule(rules.UNIQUE, "n"), (5, 0, True)),
        (Rule(rules.UNIQUE, "gone"), (5, 5, False)),
        (Rule(rules.BETWEEN, "n", low=0, high=10), (5, 2, False)),
        (Rule(rules.BETWEEN, "n", low=-1), (5, 0, True)),
        (Rule(rules.BETWEEN, "n", high=11), (5, 0, True)),
        (Rule(rules.BETWEEN, "v", low="a", high="b"), (5, 1, False)),
        (Rule(rules.BETWEEN, "v", low=0), (5, 4, False)),
        (Rule(rules.IN_SET, "v", allowed=("a",)), (5, 2, False)),
        (Rule(rules.IN_SET, "v", allowed=("a", "b", "z")), (5, 0, True)),
        (Rule(rules.IN_SET, "n", allowed=("1", "5", "11", "-1")), (5, 0, True)),
        (Rule(rules.OF_TYPE, "n", family="INTEGER"), (5, 0, True)),
        (Rule(rules.OF_TYPE, "t", family="TIMESTAMP"), (5, 0, True)),
        (Rule(rules.OF_TYPE, "k", family="TIMESTAMP"), (5, 5, False)),
    ],
    ids=lambda x: f"{x.kind[7:]}-{x.column}" if isinstance(x, Rule) else "",
)
def test_each_rule(spark, rule, expected):
    assert outcome(spark, rule) == expected


CELLS = st.tuples(
    st.one_of(st.none(), st.sampled_from("abc")),
    st.one_of(st.none(), st.sampled_from("xyz")),
    st.one_of(st.none(), st.integers(-5, 15)),
)


@settings(max_examples=8, deadline=None)
@given(st.lists(CELLS, max_size=40))
def test_rules_like_counting_by_hand(spark, rows):
    suite = Suite(
        "s",
        (
            Rule(rules.NOT_NULL, "k"),
            Rule(rules.UNIQUE, "k"),
            Rule(rules.UNIQUE, "n"),
            Rule(rules.BETWEEN, "n", low=0, high=10),
            Rule(rules.IN_SET, "v", allowed=("x", "y")),
        ),
    )
    frame = spark.createDataFrame([(*r, None) for r in rows], SCHEMA)
    got = {r["idx"]: r["n_unexpected"] for r in quality.run_suite(frame, suite, "t").collect()}
    keys, numbers = Counter(r[0] for r in rows), Counter(r[2] for r in rows)
    assert got == {
        0: keys[None],
        1: sum(n for k, n in keys.items() if k is not None and n > 1),
        2: sum(n for k, n in numbers.items() if k is not None and n > 1),
        3: sum(1 for r in rows if r[2] is not None and not 0 <= r[2] <= 10),
        4: sum(1 for r in rows if r[1] == "z"),
    }
    tagged = quality.row_tags(frame, suite).collect()
    assert sum(len(r["dq_failures"]) for r in tagged) == got[0] + got[3] + got[4]


def test_empty_table(spark):
    suite = Suite(
        "s",
        (Rule(rules.NOT_NULL, "k"), Rule(rules.UNIQUE, "k"), Rule(rules.EXISTS, "gone"), Rule(rules.UNIQUE, "gone")),
    )
    got = quality.run_suite(spark.createDataFrame([], SCHEMA), suite, "t").orderBy("idx").collect()
    assert [(r["n_rows"], r["n_unexpected"], r["success"]) for r in got] == [
        (0, 0, True), (0, 0, True), (0, 0, False), (0, 0, False),
    ]


def test_rules_must_be_complete():
    for kind, settings in ((rules.BETWEEN, {}), (rules.IN_SET, {}), (rules.OF_TYPE, {}), ("expect_other", {})):
        with pytest.raises(ValueError):
            Rule(kind, "c", **settings)


def test_suites_hold_27_rules():
    assert {s.name: len(s.rules) for s in rules.SUITES.values()} == {
        "hackernews_expectations": 6, "github_expectations": 9, "youtube_expectations": 12,
    }


def test_row_rules_share_one_aggregate(spark, plan_of):
    suite = Suite(
        "s",
        (
            Rule(rules.NOT_NULL, "k"),
            Rule(rules.BETWEEN, "n", low=0),
            Rule(rules.IN_SET, "v", allowed=("a",)),
            Rule(rules.EXISTS, "k"),
            Rule(rules.OF_TYPE, "t", family="TIMESTAMP"),
        ),
    )
    plan = plan_of(quality.run_suite(spark.createDataFrame(ROWS, SCHEMA), suite, "t"))
    assert plan.count("Exchange") == 1


def test_unique_counts_copies_before_the_shuffle(spark, plan_of):
    plan = plan_of(quality.run_suite(spark.createDataFrame(ROWS, SCHEMA), Suite("s", (Rule(rules.UNIQUE, "k"),)), "t"))
    assert plan.count("Exchange") == 2 and "partial_count" in plan


def test_row_tags(spark):
    suite = Suite(
        "s",
        (
            Rule(rules.NOT_NULL, "k"),
            Rule(rules.UNIQUE, "k"),
            Rule(rules.BETWEEN, "n", low=0),
            Rule(rules.EXISTS, "gone"),
        ),
    )
    tagged = quality.row_tags(spark.createDataFrame(ROWS, SCHEMA), suite).collect()
    gone = "expect_column_to_exist:gone"
    null = "expect_column_values_to_not_be_null:k"
    low = "expect_column_values_to_be_between:n"
    assert [r["dq_failures"] for r in tagged] == [[gone], [gone], [gone], [null, gone], [null, low, gone]]


def checkpoint(spark, run="run-1"):
    suites = {
        "good": Suite("good", (Rule(rules.NOT_NULL, "n"),)),
        "bad": Suite("bad", (Rule(rules.NOT_NULL, "k"), Rule(rules.UNIQUE, "k"))),
    }
    frame = spark.createDataFrame(ROWS, SCHEMA)
    tables = {"one": frame.where("n IS NOT NULL"), "two": frame}
    return quality.run_checkpoint(tables, suites, [("one", "good"), ("two", "bad")], run)


def test_checkpoint_and_tally(spark):
    got = checkpoint(spark)
    assert got.count() == 3
    per_suite = {r["suite"]: (r["passed"], r["failed"], r["success"]) for r in quality.tally(got, "suite").collect()}
    assert per_suite == {"good": (1, 0, True), "bad": (0, 2, False)}
    assert tuple(quality.tally(got).first()) == (1, 2, False)
    assert tuple(quality.tally(got.where("false")).first()) == (0, 0, False)


def test_checkpoint_names_must_be_given(spark):
    with pytest.raises(ValueError, match="table"):
        quality.run_checkpoint({}, {}, [("one", "good")])
    with pytest.raises(ValueError, match="suite"):
        quality.run_checkpoint({"one": spark.range(1)}, {}, [("one", "good")])


def test_results_are_stored_per_run(spark):
    store = folders.work_folder(spark, "results-test")
    for run in ("run-1", "run-2", "run-2"):
        stored = results.store_results(checkpoint(spark, run), store, run)
        assert stored.count() == 3 and {r["run"] for r in stored.collect()} == {run}
    kept = results.read_results(spark, store)
    assert {tuple(r) for r in kept.groupBy("run").count().collect()} == {("run-1", 3), ("run-2", 3)}
    parameters = results.read_parameters(spark, store).where("run = 'run-1' AND suite = 'good'")
    assert {(r["metric"], r["value"]) for r in parameters.collect()} == {("n_rows", 4), ("n_unexpected", 0)}


def test_suite_and_checkpoint_documents(spark, tmp_path):
    named = {
        "expectation_suite_name": "orders_suite",
        "expectations": [
            {"expectation_type": rules.NOT_NULL, "kwargs": {"column": "id"}, "meta": {}},
            {"expectation_type": rules.BETWEEN, "kwargs": {"column": "n", "min_value": 0, "max_value": 10**10}},
        ],
    }
    unnamed = {
        "expectations": [
            {"expectation_type": rules.IN_SET, "kwargs": {"column": "t", "value_set": ["a", "b"]}},
            {"expectation_type": rules.OF_TYPE, "kwargs": {"column": "t", "type_": "INTEGER"}},
        ]
    }
    document = {
        "name": "nightly",
        "run_name_template": "%Y-run",
        "validations": [
            {"batch_request": {"data_asset_name": "b"}, "expectation_suite_name": "orders_suite"},
            {"batch_request": {"data_asset_name": "a"}, "expectation_suite_name": "by_file"},
        ],
    }
    suites = tmp_path / "suites"
    suites.mkdir()
    (suites / "x.json").write_text(json.dumps(named, indent=2))
    (suites / "by_file.json").write_text(json.dumps(unnamed, indent=2))
    (tmp_path / "checkpoint.json").write_text(json.dumps(document, indent=2))
    read = definitions.read_suites(spark, str(suites))
    assert read["orders_suite"].rules == (
        Rule(rules.NOT_NULL, "id"),
        Rule(rules.BETWEEN, "n", low=0, high=10**10),
    )
    assert read["by_file"].rules == (
        Rule(rules.IN_SET, "t", allowed=("a", "b")),
        Rule(rules.OF_TYPE, "t", family="INTEGER"),
    )
    assert set(read) == {s.name for s in read.values()} == {"orders_suite", "by_file"}
    pairs = definitions.read_validations(spark, str(tmp_path / "checkpoint.json"))
    assert pairs == [("b", "orders_suite"), ("a", "by_file")]


@pytest.mark.parametrize("extra", [{"mostly": 0.9}, {"strict_min": True}])
def test_arguments_that_are_not_understood_are_errors(extra):
    with pytest.raises(ValueError, match="not understood"):
        definitions.rule_of(rules.BETWEEN, {"column": "x", "min_value": "0.5", **extra})


def test_bounds_keep_their_value():
    rule = definitions.rule_of(rules.BETWEEN, {"column": "x", "min_value": "0.5", "max_value": "10"})
    assert (rule.low, rule.high) == (0.5, 10)
