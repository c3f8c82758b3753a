"""Layered models: staging and intermediate as views, marts as tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# How each layer is materialised and tagged.
LAYERS = {"staging": "view", "intermediate": "view", "marts": "table"}


@dataclass(frozen=True)
class Model:
    """A named query; SQL text or a function of the session."""

    name: str
    layer: str
    query: str | Callable[[SparkSession], DataFrame]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.sql(self.query) if isinstance(self.query, str) else self.query(spark)


def model_catalogue(spark: SparkSession, models: list[Model]) -> DataFrame:
    rows = [(m.name, m.layer, LAYERS[m.layer], [m.layer]) for m in models]
    return spark.createDataFrame(
        rows, "name STRING, layer STRING, materialized STRING, tags ARRAY<STRING>"
    )


def with_tag(catalogue: DataFrame, tag: str) -> DataFrame:
    return catalogue.where(F.array_contains("tags", tag))


def materialize(
    spark: SparkSession, models: list[Model], folder: str, tag: str | None = None
) -> list[str]:
    """Build the models in the order given; `tag` picks a layer. Returns their names.

    Tables are written below `folder`, which all executors must share.
    """
    wanted = {m.name for m in models}
    if tag is not None:
        wanted = {r["name"] for r in with_tag(model_catalogue(spark, models), tag).collect()}
    built = []
    for model in models:
        if model.name not in wanted:
            continue
        frame = model.frame(spark)
        if LAYERS[model.layer] == "view":
            frame.createOrReplaceTempView(model.name)
        else:
            path = f"{folder.rstrip('/')}/{model.name}"
            frame.write.mode("overwrite").option("path", path).saveAsTable(model.name)
        built.append(model.name)
    return built


def write_warehouse(
    frame: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    mode: str = "append",
    *,
    max_connections: int,
    batch_size: int = 10000,
) -> None:
    """Load a table into the analytics database; needs its driver on the classpath.

    The rows are spread over a bounded number of connections by a shuffle, so
    that the work before it keeps its own parallelism.
    """
    (
        frame.repartition(max_connections)
        .write.mode(mode)
        .option("batchsize", batch_size)
        .jdbc(url, table, properties=properties or {})
    )
