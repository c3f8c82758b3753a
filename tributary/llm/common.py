"""What the operators share: written steps, batch sizes, folds and shipping of the code."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import time
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.folders import work_folder


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read back.

    Cuts the lineage: a lost executor costs at most the step that is running.
    """
    spark = frame.sparkSession
    path = work_folder(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most `rows` rows for what is run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release(spark: SparkSession) -> None:
    """Let the JVM drop the shuffle files of finished steps.

    Spark removes them once the driver has collected the objects that refer to them, first
    Python's and then its own, which it may otherwise put off until the disk is full.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def fold(column: str, parts: int = 5) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most `rows` rows, which bounds the arrays made of their texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of this application, wherever it was started from."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="tributary-code-")) / "tributary_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted((root / "tributary").rglob("*.py")):
            out.write(path, str(path.relative_to(root)))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
