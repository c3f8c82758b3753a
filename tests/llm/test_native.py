"""Line dedup, mixing and decontamination, also against their SQL on other rows."""

from __future__ import annotations

import random

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as spark_entry
from check import TABLES, rows_of
from tributary.llm import decontaminate, lines, mixing

SQL = ["op2_benchmark_decontamination", "op8_site_line_dedup", "op10_source_mixing"]


@pytest.mark.parametrize("name", SQL)
def test_query_like_its_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    frame, relation = spark_entry.queries()[name](spark, folder), db.sql(spark_entry.oracle_sql()[name])
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(relation.columns, relation.fetchall())


def pages(spark, rows):
    return spark.createDataFrame(rows, "page BIGINT, host STRING, text STRING, keys STRING, total INT")


def test_boilerplate_is_relative_to_the_host(spark):
    rows = [(i, "a", f"menu\n\n own {i}\nmenu ", "k", 1) for i in range(4)]
    rows += [(10 + i, "b", "menu\nother" if i == 0 else f"x{i}", "k", 1) for i in range(9)]
    rows += [(30, None, "menu\nmenu", "k", 1), (31, "c", None, "k", 1), (32, "c", "", "k", 1), (33, "d", "menu", "k", 1)]
    found = {r["page"]: r for r in lines.drop_boilerplate(pages(spark, rows), host="host").collect()}
    assert len(found) == len(rows)
    assert found[2]["text"] == "\n own 2" and (found[2]["n_lines"], found[2]["n_dropped"]) == (3, 2)
    assert found[10]["text"] == "menu\nother"  # one page in nine
    assert found[30]["text"] == "menu\nmenu" and found[33]["text"] == "menu"
    assert found[31]["text"] is None and found[31]["n_lines"] == 0 and found[32]["text"] == ""
    assert found[2]["keys"] == "k" and found[2]["total"] == 1
    assert lines.drop_boilerplate(pages(spark, []), host="host").collect() == []


def test_line_plan_has_no_python(spark, plan_of):
    plan = plan_of(lines.drop_boilerplate(pages(spark, [(1, "a", "b", "k", 1)]), host="host"))
    assert "Python" not in plan and "Arrow" not in plan and "Window" not in plan


def mixture(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, source STRING, text STRING, epochs INT, block INT")


def test_mixing_meets_entropy_budget_and_repeats(spark):
    rng = random.Random(1)
    rows = [(i, "big" if i % 10 else f"s{i % 3}", "w " * rng.randint(0, 30), 1, 1) for i in range(3000)]
    rows += [(9000, None, "a b", 1, 1), (9001, "blank", "", 1, 1), (9002, "blank", None, 1, 1), (9003, "big", None, 1, 1)]
    drawn = mixing.mix(mixture(spark, rows), max_repeats=3.0, blocks=64).toPandas()
    total = sum(len((t or "").split()) for _, _, t, _, _ in rows)
    assert total * 0.97 < drawn["n_tokens"].sum() <= total
    assert "blank" not in set(drawn["source"]) and drawn["epoch"].max() <= 3
    per_source = drawn.groupby("source")["n_tokens"].sum()
    assert per_source["big"] < sum(len((t or "").split()) for _, s, t, _, _ in rows if s == "big")
    # A whole epoch holds every document of its source once; the part of one is a prefix of its blocks.
    for source, part in drawn[drawn["source"].notna()].groupby("source"):
        ids = {i for i, s, _, _, _ in rows if s == source}
        for epoch, own in part.groupby("epoch"):
            assert own["doc_id"].is_unique
            if epoch < part["epoch"].max():
                assert set(own["doc_id"]) == ids
    assert drawn["epochs"].eq(1).all()
    assert sorted(drawn.columns) == sorted(["doc_id", "source", "text", "epochs", "n_tokens", "epoch", "block", "position"])


def test_mixing_of_nothing(spark):
    assert mixing.mix(mixture(spark, [])).collect() == []
    assert mixing.mix(mixture(spark, [(1, "a", None, 1, 1), (2, None, "", 1, 1)])).collect() == []
    one = mixing.mix(mixture(spark, [(1, "a", "x y", 1, 1), (1, "a", "x y", 1, 1)])).collect()
    assert len(one) == 2


def test_contamination_needs_question_and_answer(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    item = [word() for _ in range(30)]
    question, answer = " ".join(item[:20]) + ".", " ".join(item[20:]) + "."
    filler = lambda n: " ".join(word() for _ in range(n))
    rows = [
        (1, f"{filler(300)} {question} {answer} {filler(50)}"),
        (2, f"{filler(100)} {question.upper()}\n{answer.upper()}***"),
        (3, f"{filler(100)} {question} {filler(100)}"),
        (4, filler(400)),
        (5, None),
        (6, ""),
        (7, f"{filler(5000)} {question} {answer}"),
        (7, f"{question} {answer}"),
        (None, f"{question} {answer}"),
    ]
    documents = pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64"})
    items = [(1, f"{question} {answer}"), (2, None), (3, ""), (4, filler(40)), (1, f"{question} {answer}")]
    frames = [
        spark.createDataFrame([(None if pd.isna(i) else int(i), t, "x") for i, t in documents.itertuples(index=False)], "doc_id BIGINT, text STRING, passage STRING"),
        spark.createDataFrame(items, "item_id BIGINT, text STRING"),
    ]
    for at_once in (1000, 2):
        found = decontaminate.contaminated(*frames, items_at_once=at_once).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, 1), (2, 1), (7, 1), (None, 1)}
    assert decontaminate.contaminated(frames[0].limit(0), frames[1]).collect() == []
    assert decontaminate.contaminated(frames[0], frames[1].limit(0)).collect() == []
