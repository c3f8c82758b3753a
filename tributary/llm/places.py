"""The place of every row within its group, whatever the size of the group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import written


def with_places(frame: DataFrame, group: list[str], order: list[Column], purpose: str) -> DataFrame:
    """The rows with `place`, counted from 0 in their group by `order`, nulls first.

    Rows are dealt by ranges of group and order, so a large group is spread over tasks; only the
    row counts of its parts, at most one per task, are added up in one place. Rows that `order`
    does not tell apart are told apart by `__n`, which the caller has stored with them.
    """
    spark = frame.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(c).asc_nulls_first() for c in group], *order, F.col("__n").asc()]
    dealt = frame.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    # a task's rows are numbered from its number shifted by 33 bits; writing fixes the numbers
    dealt = written(dealt.withColumn("__at", F.monotonically_increasing_id()), purpose)
    dealt = dealt.withColumn("__part", F.shiftright("__at", 33))
    runs = dealt.groupBy(*group, "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    earlier = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__rows").over(earlier), F.lit(0))
    shifts = runs.select(F.col("__part").alias("__p"), *[F.col(c).alias(f"__{c}") for c in group], (before - F.col("__first")).alias("__shift"))
    same = F.col("__part") == F.col("__p")
    for column in group:
        same &= F.col(column).eqNullSafe(F.col(f"__{column}"))
    placed = dealt.join(shifts, same).withColumn("place", F.col("__at") + F.col("__shift"))
    return placed.select(*[c for c in frame.columns if c != "__n"], "place")
