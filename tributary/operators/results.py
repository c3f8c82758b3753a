"""Where quality results are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary import folders
from tributary.operators.quality import evaluation_parameters


def store_results(results: DataFrame, folder: str, run: str) -> DataFrame:
    """Write a run's rule rows and observed values; return the rule rows as stored.

    A run has its own folder, so writing it again replaces it. The rows handed
    back come from storage: the suites are not run a second time.
    """
    spark = results.sparkSession
    path = f"{folder.rstrip('/')}/validation_results/run_name={run}"
    results.write.mode("overwrite").parquet(path)
    folders.finish(spark, path)
    stored = spark.read.schema(results.schema).parquet(path)
    parameters = f"{folder.rstrip('/')}/evaluation_parameters/run_name={run}"
    evaluation_parameters(stored).write.mode("overwrite").parquet(parameters)
    folders.finish(spark, parameters)
    return stored


def read_results(spark: SparkSession, folder: str) -> DataFrame:
    return _finished(spark, f"{folder.rstrip('/')}/validation_results")


def read_parameters(spark: SparkSession, folder: str) -> DataFrame:
    return _finished(spark, f"{folder.rstrip('/')}/evaluation_parameters")


def _finished(spark: SparkSession, base: str) -> DataFrame:
    """The rows of all finished runs."""
    runs = [n for n in folders.children(spark, base) if folders.exists(spark, f"{base}/{n}/{folders.FINISHED}")]
    if not runs:
        raise ValueError(f"no finished run below {base}")
    return spark.read.option("basePath", base).parquet(*[f"{base}/{n}" for n in runs])
