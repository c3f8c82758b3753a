"""Connected components of a link table, as Spark joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import written


def components(links: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, component) for every node of `links` (a, b).

    Each round maps a node to the neighbour (or itself) of the highest degree, ties by a
    hash that changes by round, goes on to where that one was mapped, and merges the nodes
    that meet. A star is done in one round, and of a chain a constant share of the nodes is
    left after each. `component` names a component and is one of its nodes. Self links keep
    a node in the result; null links are dropped.
    """
    links = links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    edges = links.where("a <> b").distinct()
    steps = []
    for turn in range(rounds):
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(edges.select("b", "a"))
        # Stored, so that the join below has plain rows on both sides and a hub can be split.
        degrees = written(both.groupBy("node").agg(F.count(F.lit(1)).alias("degree")), "components-degrees")
        if degrees.isEmpty():
            break
        rank = F.struct("degree", F.xxhash64(F.lit(turn), "near").alias("h"), F.col("near").alias("to"))
        ranked = both.union(degrees.select("node", F.col("node").alias("near"))).join(
            degrees.withColumnRenamed("node", "near"), "near"
        )
        first = ranked.groupBy("node").agg(F.max(rank).alias("r")).select("node", F.col("r.to").alias("to"))
        first = written(first, "components-first")
        second = first.select(F.col("node").alias("to"), F.col("to").alias("next"))
        step = first.join(second, "to").select("node", F.col("next").alias("to"))
        steps.append(step)
        mapped = (
            edges.join(step.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .where("x <> y")
        )
        edges = written(
            mapped.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "components-edges",
        )
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    labels = nodes.withColumn("component", F.col("node"))
    for step in steps:
        labels = labels.join(step.withColumnRenamed("node", "component"), "component", "left").select(
            "node", F.coalesce("to", "component").alias("component")
        )
    return written(labels, "components-labels")


def joined_components(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels (node, component) after more links; without earlier labels, those of the links."""
    if labels is None:
        return components(links)
    named = links.select("a", "b")
    for side in ("a", "b"):
        to = labels.select(F.col("node").alias(side), F.col("component").alias("to"))
        named = named.join(to, side, "left").withColumn(side, F.coalesce("to", side)).drop("to")
    fresh = components(named)
    known = labels.select("node", "component")
    # A node that only the new links name is its own component so far.
    known = known.union(
        fresh.join(known.select(F.col("component").alias("node")).distinct(), "node", "left_anti").select(
            "node", F.col("node").alias("component")
        )
    )
    return written(
        known.join(fresh.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left").select(
            "node", F.coalesce("to", "component").alias("component")
        ),
        "components-labels",
    )
