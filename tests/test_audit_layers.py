from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tributary import folders, schemas, session
from tributary.operators import audit, layers, quality
from tributary.operators.layers import Model
from tributary.sources import bronze, definitions, landed


def records(spark, rows):
    return spark.createDataFrame(rows, "topic STRING, partition INT, offset BIGINT")


def test_messages_per_topic(spark):
    frame = records(spark, [("a", 0, 0), ("a", 0, 4), ("a", 1, 2), ("b", 0, 0)])
    got = {r["topic"]: (r["n_partitions"], r["n_messages"]) for r in audit.topic_message_count(frame).collect()}
    assert got == {"a": (2, 8), "b": (1, 1)}
    checks = audit.topic_audit(frame, ["a", "missing"])
    assert {tuple(r) for r in checks.collect()} == {("a", 8, True), ("missing", 0, False)}
    assert tuple(quality.tally(checks).first()) == (1, 1, False)


def test_landing_audit(spark):
    root = folders.work_folder(spark, "audit-test")
    stories = spark.createDataFrame([(1, "t"), (2, "u")], "id BIGINT, title STRING")
    stories.repartition(2).write.parquet(bronze.leaf_path(root, "hackernews"))
    spark.createDataFrame([], stories.schema).write.parquet(bronze.leaf_path(root, "youtube"))
    required = {"hackernews": ["id", "title"], "youtube": ["title", "tags"], "github": ["id"]}
    rows = {r["source"]: r for r in audit.landing_audit(spark, root, required).collect()}
    found = rows["hackernews"]
    assert (found["n_files"], found["n_rows"], found["missing_columns"]) == (2, 2, "")
    assert found["has_files"] and found["has_rows"] and found["has_columns"]
    assert rows["youtube"]["n_rows"] == 0 and not rows["youtube"]["has_rows"]
    assert rows["youtube"]["missing_columns"] == "tags"
    assert not rows["github"]["has_files"] and rows["github"]["missing_columns"] == "id"
    checks = audit.landing_checks(audit.landing_audit(spark, root, required))
    assert checks.count() == 9
    assert quality.tally(checks).first()["success"] is False


def test_topic_catalogue(spark, tmp_path):
    document = {
        "topics": {
            "a": {"partitions": 3, "retention_ms": 86400000, "cleanup_policy": "delete"},
            "b": {"partitions": 1, "retention_ms": 5},
        },
        "common_config": {"replication_factor": 1},
    }
    (tmp_path / "topics.json").write_text(json.dumps(document, indent=2))
    declared = definitions.read_topic_catalogue(spark, str(tmp_path / "topics.json"))
    rows = {r["topic"]: r for r in declared.collect()}
    assert rows["a"]["retention_ms"] == 86400000 and rows["b"]["cleanup_policy"] is None
    assert rows["a"]["common_config"] == {"replication_factor": 1}
    found = spark.createDataFrame([("a", 3), ("b", 3), ("c", 1)], "topic STRING, partitions INT")
    verdicts = {r["topic"]: r["success"] for r in audit.catalogue_audit(declared, found, ["partitions"]).collect()}
    assert verdicts == {"a": True, "b": False, "c": False}


MODELS = [
    Model("t_staged", "staging", lambda spark: spark.range(10).withColumn("g", F.col("id") % 3)),
    Model("t_between", "intermediate", "SELECT g, count(*) AS n FROM t_staged GROUP BY g"),
    Model("t_mart", "marts", "SELECT max(n) AS top FROM t_between"),
]


def test_layers_by_tag(spark):
    folder = folders.work_folder(spark, "layers-test")
    assert layers.materialize(spark, MODELS, folder, tag="staging") == ["t_staged"]
    assert not spark.catalog.tableExists("t_mart")
    assert layers.materialize(spark, MODELS, folder) == ["t_staged", "t_between", "t_mart"]
    assert spark.table("t_mart").first()["top"] == 4
    kinds = {t.name: t.isTemporary for t in spark.catalog.listTables() if t.name.startswith("t_")}
    assert kinds == {"t_staged": True, "t_between": True, "t_mart": False}
    layers.materialize(spark, MODELS, folder + "-again")
    assert spark.table("t_mart").count() == 1
    spark.sql("DROP TABLE t_mart")


def test_model_catalogue(spark):
    rows = layers.model_catalogue(spark, MODELS)
    assert [r["name"] for r in layers.with_tag(rows, "marts").collect()] == ["t_mart"]
    assert {r["layer"]: r["materialized"] for r in rows.collect()} == {
        "staging": "view", "intermediate": "view", "marts": "table",
    }


def test_warehouse_needs_its_driver(spark):
    with pytest.raises(Exception, match="(?i)driver|jdbc"):
        layers.write_warehouse(spark.range(1), "jdbc:postgresql://host/analytics_db", "t", max_connections=16)


def test_session_options():
    store = session.object_store_options("https://store.example", "key", "secret")
    assert store["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert store["spark.hadoop.fs.s3a.endpoint"] == "https://store.example"
    assert session.KAFKA_PACKAGE.endswith(f"_2.13:{session.SPARK_VERSION}")
    import pyspark

    assert pyspark.__version__ == session.SPARK_VERSION


def test_shuffle_partitions_follow_the_data():
    assert session.sized_for(1 << 20) == {"spark.sql.shuffle.partitions": "200"}
    assert session.sized_for(100 << 40) == {"spark.sql.shuffle.partitions": str(100 << 13)}


def test_session_builder_reuses_the_session(spark):
    assert session.session("other", options={"spark.sql.shuffle.partitions": "4"}) is not None
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert folders.work_folder(spark, "x").startswith(root)
    assert folders.work_folder(spark, "x") != folders.work_folder(spark, "x")


def test_lines_that_are_not_json_stay_visible(spark, tmp_path):
    (tmp_path / "items.txt").write_text('{"id":1}\nnot json\nnull\n')
    lines = landed.read_lines(spark, str(tmp_path / "items.txt"))
    assert lines.count() == 3
    assert [r["id"] for r in landed.story_items(lines).collect()] == [1]


def test_registry():
    assert schemas.source("github").topic == "github-events"
    with pytest.raises(ValueError):
        schemas.source("GitHub")


def test_a_leaf_without_a_committed_file_fails_and_does_not_raise(spark):
    from tributary.operators.audit import landing_audit
    from tributary.sources import bronze

    root = folders.work_folder(spark, "empty-leaf")
    fs, path = folders._file_system(spark, bronze.leaf_path(root, "github"))
    fs.mkdirs(path)
    row = landing_audit(spark, root, {"github": ["id"]}).first()
    assert (row["n_files"], row["has_files"], row["has_rows"], row["has_columns"]) == (0, False, False, False)
