"""The training-text pipeline: stages over `documents`, each written and read again.

Every stage takes the documents that the one before kept. All but the last return the columns
of `documents`; the last adds where a document stands in the mix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import decontaminate, lines, minhash, mixing, quality
from tributary.llm.common import ship, written

SOURCE_SHARE, SOURCE_DOCUMENTS = 0.02, 10

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    ship(spark)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, model, threshold=0.3)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that too many documents of a source share go; a document left without lines stays, empty.

    A source is far larger than a site, so besides the rule for sites a line goes that more than
    SOURCE_SHARE of the documents of a source hold, and at least SOURCE_DOCUMENTS of them.
    """
    cleaned = lines.drop_boilerplate(docs, host="source", also=(SOURCE_SHARE, SOURCE_DOCUMENTS))
    cleaned = cleaned.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*docs.columns)


def _named(docs: DataFrame) -> tuple[DataFrame, bool]:
    """The rows with a name each, `__row`: the doc_id where every row has one of its own, which is told."""
    ids = docs.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("doc_id").alias("ids")).first()
    if ids.rows == ids.ids:
        return docs.withColumn("__row", F.col("doc_id")), True
    # names for the rows, fixed by writing them
    return written(docs.withColumn("__row", F.monotonically_increasing_id()), "pipeline-rows"), False


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays, the one of the smallest id.

    Rows that repeat a doc_id with another text are documents of their own, and of those that
    repeat its text as well one stays; all rows without a doc_id stay.
    """
    ship(spark)
    rows, plain = _named(docs)
    if plain:
        kept = minhash.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("__row"))
        return rows.join(written(kept, "pipeline-kept"), "__row", "left_semi").select(*docs.columns)
    known = rows.where("doc_id IS NOT NULL")
    first = written(known.groupBy("doc_id", "text").agg(F.min("__row").alias("__row")).select("__row"), "pipeline-first")
    once = known.join(first, "__row", "left_semi").select(F.struct("doc_id", "__row").alias("doc_id"), "text")
    kept = written(minhash.near_duplicates(once).where("kept").select("doc_id.__row"), "pipeline-kept")
    left = known.join(kept, "__row", "left_semi").select(*docs.columns)
    return left.union(rows.where("doc_id IS NULL").select(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go, whatever their doc_id."""
    ship(spark)
    rows, _ = _named(docs)
    named = rows.select(F.col("__row").alias("doc_id"), "text")
    found = decontaminate.contaminated(named, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaks = written(found.select(F.col("doc_id").alias("__row")).distinct(), "pipeline-leaks")
    return rows.join(leaks, "__row", "left_anti").select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source is drawn, with epoch, block and position."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_filter", quality_filter),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
]

# The classifier cannot be written in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
