"""The stages over the smallest tables, and over rows with nulls, copies and clashes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import words
from tributary.llm import decontaminate
from tributary.llm.common import written

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(name, documents before, documents after) of each stage."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, FOLDER), "pipeline-test")
        out.append((name, docs, after))
        docs = after
    return out


def rows(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_names_and_columns(stages):
    assert [name for name, _, _ in stages] == [
        "quality_filter", "line_dedup", "near_dedup", "decontamination", "source_mixing",
    ]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns == list(("doc_id", "text", "lang", "source", "n_chars"))


def test_quality_filter_rejects_what_is_labelled_low(spark, stages):
    _, before, after = stages[0]
    labels = rows(spark.read.parquet(f"{FOLDER}/labels.parquet"))
    kept, all_rows = rows(after), rows(before)
    wrong = sum((i in kept) != (r["quality"] == 1) for i, r in labels.items() if i in all_rows)
    assert wrong <= 0.05 * len(labels)
    assert all(kept[i] == all_rows[i] for i in kept)


def test_line_dedup_like_a_loop(stages):
    _, before, after = stages[1]
    before, after = rows(before), rows(after)
    assert set(before) == set(after)
    hosts, holds = {}, {}
    for r in before.values():
        hosts[r["source"]] = hosts.get(r["source"], 0) + 1
        for line in {x.strip(" ") for x in r["text"].split("\n")} - {""}:
            holds[r["source"], line] = holds.get((r["source"], line), 0) + 1
    for i, r in before.items():
        keep = [
            x for x in r["text"].split("\n")
            if not (holds.get((r["source"], x.strip(" ")), 0) >= 3 and holds[r["source"], x.strip(" ")] / hosts[r["source"]] > 0.3)
        ]
        assert after[i]["text"] == "\n".join(keep) and after[i]["n_chars"] == len(after[i]["text"])


def test_one_document_of_each_component_stays(stages):
    _, before, after = stages[2]
    before, after = rows(before), rows(after)
    sets = {}
    for i, r in before.items():
        w = words(r["text"])
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if j < i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert set(after) == {i for i in sets if find(i) == i}


def test_documents_with_benchmark_items_go(spark, stages):
    _, before, after = stages[3]
    found = decontaminate.contaminated(before, spark.read.parquet(f"{FOLDER}/benchmark.parquet"))
    leaks = {r["doc_id"] for r in found.collect()}
    assert leaks and set(rows(after)) == set(rows(before)) - leaks


def test_last_stage_draws_from_what_is_left(stages):
    _, before, after = stages[4]
    assert {r["doc_id"] for r in after.collect()} <= set(rows(before))
    assert {"epoch", "block", "position", "n_tokens"} <= set(after.columns)


def test_stages_with_odd_rows(spark):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    text = " ".join(f"w{i}" for i in range(30))
    odd = [
        (1, text, "en", "a", 10), (1, text, "en", "a", 10), (2, text, None, None, None), (3, None, "en", "a", 0),
        (4, "", "en", "b", 0), (None, text, "en", "b", 1), (None, None, None, None, None),
    ]
    docs = spark.createDataFrame(odd, schema).withColumn("epochs", F.lit(1)).withColumn("keys", F.lit("k"))
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, frame, FOLDER)
            got = after.collect()
            if name in ("line_dedup",):
                assert len(got) == frame.count()
            if name == "near_dedup" and frame is docs:
                ids = sorted(r["doc_id"] for r in got if r["doc_id"] is not None)
                assert ids == [1, 3, 4] and sum(r["doc_id"] is None for r in got) == 2
            assert set(frame.columns) <= set(after.columns)


def test_run_is_the_stages_in_order(spark, stages):
    wanted = sorted(map(str, stages[-1][2].drop("text").collect()))
    assert sorted(map(str, corpus_pipeline.run(spark, FOLDER).drop("text").collect())) == wanted


def test_planted_lines_of_a_large_source_go(spark):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    own = lambda i: f"only line {i}\nanother of {i}"
    # 12 of 300 documents share a line, 9 of 300 another, 8 of 20 a third in a small source.
    texts = {i: own(i) + ("\nSubscribe now " if i < 12 else "\nrare phrase" if i < 21 else "") for i in range(300)}
    small = {i: own(i) + ("\nSmall print" if i < 308 else "") for i in range(300, 320)}
    data = [(i, t, "en", "large", len(t)) for i, t in texts.items()] + [(i, t, "en", "small", len(t)) for i, t in small.items()]
    after = rows(corpus_pipeline.line_dedup(spark, spark.createDataFrame(data, schema), FOLDER))
    for i, t in (texts | small).items():
        want = t if 12 <= i < 300 or i >= 308 else own(i)
        assert after[i]["text"] == want and after[i]["n_chars"] == len(want)


def test_rows_are_judged_by_themselves(spark):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").where("length(text) > 60").first()["text"]
    one, two, three = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    data = [(5, one), (5, two), (5, two), (6, two), (7, item), (7, three), (None, item), (None, three)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in data], schema)
    texts = lambda stage: sorted((r["doc_id"] or 0, r["text"]) for r in stage(spark, docs, FOLDER).collect())
    assert texts(corpus_pipeline.near_dedup) == sorted([(0, item), (0, three), (5, one), (5, two), (7, item), (7, three)])
    assert texts(corpus_pipeline.decontamination) == sorted([(0, three), (5, one), (5, two), (5, two), (6, two), (7, three)])
