from __future__ import annotations

import json
from datetime import date, datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.functions import json as j
from tributary.functions import numbers, text, times


def values(spark, column, rows, schema="x STRING"):
    frame = spark.createDataFrame([(r,) for r in rows], schema)
    return [r[0] for r in frame.select(column).collect()]


def test_duration_edge_rows(spark):
    known = {
        "PT1H2M3S": 3723,
        "PT0S": 0,
        "PT15M": 900,
        "P1DT2H": 0,
        "PT": 0,
        "": 0,
        "PT5S junk": 5,
        "PT1.5S": 0,
        None: 0,
        " PT5S": 0,
        "PT99999999999999999999H": 0,
        "PT9000000000000000000H1S": 0,
    }
    assert values(spark, times.iso_duration_seconds("x"), known) == list(known.values())


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(0, 10**6), st.integers(0, 10**6), st.integers(0, 10**6)),
        min_size=1,
        max_size=50,
    )
)
def test_duration_of_generated_parts(spark, parts):
    texts = [f"PT{h}H{m}M{s}S" for h, m, s in parts]
    expected = [h * 3600 + m * 60 + s for h, m, s in parts]
    assert values(spark, times.iso_duration_seconds("x"), texts) == expected


def test_prefix_counts_code_points(spark):
    long = "é\U0001f600" * 400
    rows = [long, None, "", "short"]
    assert values(spark, text.text_prefix("x", 500), rows) == [long[:500], "", "", "short"]
    assert values(spark, text.title_preview("x"), [long, None]) == [long[:60], None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=700), min_size=1, max_size=10))
def test_prefix_like_python(spark, texts):
    assert values(spark, text.text_prefix("x", 500), texts) == [t[:500] for t in texts]


def test_defaults(spark):
    assert values(spark, text.default_text("x"), ["a", None]) == ["a", ""]
    assert values(spark, text.default_count("x"), [5, None], "x BIGINT") == [5, 0]
    assert values(spark, text.default_tags("x"), [["a"], [], None], "x ARRAY<STRING>") == [["a"], [], []]
    assert values(spark, text.default_object("x"), ['{"a":1}', None]) == ['{"a":1}', "{}"]
    assert values(spark, text.default_true("x"), [False, True, None], "x BOOLEAN") == [False, True, True]


def test_text_to_count(spark):
    rows = ["12", "abc", None, "", "1.5", "9999999999", "-3"]
    assert values(spark, numbers.to_count("x"), rows) == [12, 0, 0, 0, 0, 9999999999, -3]


def test_minimum_of_two(spark):
    assert values(spark, numbers.clamp("x", 50), [10, 50, 200], "x INT") == [10, 50, 50]
    assert [numbers.clamp_request(n, 50) for n in (10, 50, 200)] == [10, 50, 50]


def test_ids_split_and_join(spark):
    rows = [" a,b ,c\n", "", " \n", "one", "a,,b", None]
    assert values(spark, text.split_ids("x"), rows) == [["a", "b ", "c"], [], [], ["one"], ["a", "b"], None]
    assert values(spark, text.join_ids("x"), [["a", "b"], []], "x ARRAY<STRING>") == ["a,b", ""]


def test_trim_takes_all_whitespace(spark):
    assert values(spark, text.strip("x"), ["\t 7\r\n", "a b"]) == ["7", "a b"]


def test_empty_key_is_null(spark):
    assert values(spark, text.null_if_empty("x"), ["", "k", None]) == [None, "k", None]


def test_contains_and_queries(spark):
    rows = ["Data Engineering now", "python PROGRAMMING, technology", "none", None]
    assert values(spark, text.contains_ignoring_case("x", "DATA"), rows) == [True, False, False, None]
    found = text.matched_queries(["x"], ["technology", "data engineering", "python programming"])
    assert values(spark, found, rows) == [[1], [0, 2], [], []]


def test_epoch_and_iso(spark):
    stamps = values(spark, times.epoch_to_timestamp("x"), [0, 1704067200, None, 10**17], "x BIGINT")
    assert stamps == [datetime(1970, 1, 1), datetime(2024, 1, 1), None, None]
    rows = ["2024-01-01T00:00:05Z", "", "junk", None]
    assert values(spark, times.iso_to_timestamp("x"), rows) == [datetime(2024, 1, 1, 0, 0, 5), None, None, None]


def test_date_is_that_of_utc(spark, changed):
    changed(spark__sql__session__timeZone="America/New_York")
    rows = ["2024-01-01T00:00:05Z", "1969-12-31T23:59:59Z", "2024-01-01T23:59:59Z", None]
    assert values(spark, times.utc_date(times.iso_to_timestamp("x")), rows) == [
        date(2024, 1, 1), date(1969, 12, 31), date(2024, 1, 1), None,
    ]


def test_run_name(spark):
    moment = datetime(2024, 2, 3, 4, 5, 6)
    name = "20240203-040506-bronze-to-silver-validation"
    assert values(spark, times.run_name("x"), [moment], "x TIMESTAMP_NTZ") == [name]
    assert times.run_name_at(moment) == name


def test_object_text_keeps_nulls(spark):
    frame = spark.createDataFrame([(1, None), (2, 'q"')], "id INT, title STRING")
    got = [r[0] for r in frame.select(j.to_json_text(F.struct("id", "title"))).collect()]
    assert got == ['{"id":1,"title":null}', '{"id":2,"title":"q\\""}']


def test_raw_object_goes_in_as_it_is(spark):
    rows = [
        ("a", '{"z":1,"a":{"payload":null}}', True),
        ('"payload":null', '{"k":"}"}', None),
        ("plain", "just text", False),
        ("nothing", None, True),
    ]
    frame = spark.createDataFrame(rows, "id STRING, payload STRING, public BOOLEAN")
    texts = [r[0] for r in frame.select(j.object_text(["id", "payload", "public"], "payload")).collect()]
    assert [json.loads(t) for t in texts] == [
        {"id": "a", "payload": {"z": 1, "a": {"payload": None}}, "public": True},
        {"id": '"payload":null', "payload": {"k": "}"}, "public": None},
        {"id": "plain", "payload": "just text", "public": False},
        {"id": "nothing", "payload": None, "public": True},
    ]
    assert texts[0] == '{"id":"a","payload":{"z":1,"a":{"payload":null}},"public":true}'


def test_bytes_and_payload(spark):
    assert values(spark, j.to_text(j.to_bytes("x")), ["é", None]) == ["é", None]
    assert values(spark, j.payload_value("x", "$.k"), ['{"k": 7}', "{}", None]) == ["7", None, None]
