"""Versions of a table by date, where a new version rewrites only the dates it touches.

Rows lie in `data/run=<run>/<date column>=<date>`. A version `run=<run>` lists the folders it consists of, its own
and those of earlier runs, next to what else its maker stores. Folders of a run that died are in no list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tributary import folders

NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def folders_of(spark: SparkSession, version: str) -> list[str]:
    """`run=<run>/<column>=<date>` of a version: as many as it has dates."""
    return [r.folder for r in spark.read.schema("folder STRING").parquet(f"{version}/manifest").collect()]


def read(
    spark: SparkSession, base: str, version: str, schema: str | StructType, by: str, only: set[str] | None = None
) -> DataFrame:
    """The rows of a version, or of the dates in `only`, in one scan of their folders."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    names = [f for f in folders_of(spark, version) if only is None or f.split("=")[-1] in only]
    if not names:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(StructType(schema.fields).add("run", "string")).option("basePath", f"{base}/data")
    return reader.parquet(*[f"{base}/data/{name}" for name in names]).select(*schema.names)


def dates(rows: DataFrame, by: str) -> set[str]:
    """The dates of rows as their folders name them; a date without rows does not count."""
    named = F.coalesce(F.col(by).cast("string"), F.lit(NO_DATE))
    return {r[0] for r in rows.select(named).distinct().collect()}


def write(
    spark: SparkSession, base: str, run: str, rows: DataFrame, by: str, touched: set[str], before: str | None
) -> str:
    """The version that has `rows` for the touched dates and takes the others from version `before`; not yet finished."""
    path = f"{base}/run={run}"
    rows.hint("rebalance", by).write.partitionBy(by).parquet(f"{base}/data/run={run}")
    own = [f"run={run}/{name}" for name in folders.children(spark, f"{base}/data/run={run}") if name.startswith(f"{by}=")]
    earlier = folders_of(spark, before) if before else []
    listed = own + [name for name in earlier if name.split("=")[-1] not in touched]
    spark.createDataFrame([(name,) for name in listed], "folder STRING").coalesce(1).write.parquet(f"{path}/manifest")
    return path
