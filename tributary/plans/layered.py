"""Layered models over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary import folders
from tributary.operators.layers import Model, materialize
from tributary.plans.registry import register
from tributary.sources.tables import table


def models(folder: str) -> list[Model]:
    return [
        Model("stg_events", "staging", lambda spark: table(spark, folder, "events")),
        Model(
            "int_user_types",
            "intermediate",
            "SELECT event_type, user_id, count(*) AS n, max(event_id) AS last_id "
            "FROM stg_events GROUP BY event_type, user_id",
        ),
        Model(
            "mart_event_types",
            "marts",
            "SELECT event_type, sum(n) AS n_events, count(*) AS n_users, max(last_id) AS last_id "
            "FROM int_user_types GROUP BY event_type",
        ),
    ]


@register(
    "materialize_layers",
    "SELECT event_type, count(*) AS n_events, count(DISTINCT user_id) AS n_users, "
    "max(event_id) AS last_id FROM events GROUP BY event_type",
)
def materialize_layers(spark: SparkSession, folder: str) -> DataFrame:
    """Staging and intermediate views, then the marts table, layer by layer."""
    marts = folders.work_folder(spark, "marts")
    for layer in ("staging", "intermediate", "marts"):
        materialize(spark, models(folder), marts, tag=layer)
    return spark.table("mart_event_types")
