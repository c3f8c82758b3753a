"""One query per operator, over its whole table and with the operator's usual settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import (
    decontaminate,
    lines,
    merkle,
    minhash,
    mixing,
    neighbours,
    ngram,
    quality,
    repeats,
    secrets,
    structure_sql,
    toxicity,
    turns,
    urls,
)
from tributary.llm.registry import register
from tributary.sources.tables import table


@register("op1_minhash_near_duplicates")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


@register("op2_benchmark_decontamination", decontaminate.BENCHMARK_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("score")


@register("op3_toxicity_neighbours")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, folder, "labels")))


@register("op4_repeated_string_removal")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, folder, "documents")).drop("kept")


@register("op5_secret_scan")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"))
    text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    joined = lambda spans: F.array_join(F.transform(spans, text), ",")
    kinds = [r.name for r in secrets.BASE_RULES]
    base = F.filter("secrets", lambda s: s["kind"].isin(kinds))
    of_kind = lambda k: F.filter("secrets", lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans")
    )


@register("op6_quality_classifier")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return quality.score(documents, quality.fit(documents, table(spark, folder, "labels")), threshold=0.3)


@register("op7_language_model_scores")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return ngram.language_model_scores(table(spark, folder, "documents"))


@register("op8_site_line_dedup", lines.PAGES_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    host = F.regexp_extract("url", "://([^/:?#]+)", 1).alias("host")
    pages = table(spark, folder, "pages").select("page_id", host, lines.html_lines("html").alias("text"))
    return lines.drop_boilerplate(pages, host="host")


@register("op9_nearest_neighbours")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return neighbours.nearest_neighbours(vectors, vectors.where("vec_id % 50 = 0"))


@register("op10_source_mixing", mixing.DOCUMENTS_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).drop("text", "lang", "n_chars")


# the contract's site rules, and patterns for the farms among the hosts
URL_RULES = [
    ("site", "org/", "allow"),
    ("site", "example.org/es/", "block"),
    ("site", "example.org/en/1", "block"),
    ("site", "com/fr/", "allow"),
    ("site", "com/de/", "block"),
    ("pattern", "||casino-win.", "block"),
    ("pattern", "||ads-track.", "block"),
    ("pattern", "||free-bets.", "block"),
    ("pattern", "||spam-farm.", "block"),
    ("pattern", "||cheap-pills.", "block"),
    ("pattern", "/en/*.html^*utm_source=", "block"),
    ("pattern", "||free-bets.*/de/", "allow"),
]


@register("op11_url_filters", structure_sql.URLS_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, urls.RULE_SCHEMA)
    judged = urls.judge(table(spark, folder, "pages").select("page_id", "url"), rules)
    site = F.when(F.col("judged.kind") == "site", F.col("judged.rule")).alias("rule")
    return judged.select("page_id", "judged.host", "judged.path", site, "judged.verdict")


@register("op12_merkle_manifest", structure_sql.MANIFEST_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claimed = {"text": F.when(tampered, lowered).otherwise(F.col("text"))}
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    manifest = merkle.build(documents, fields, key="doc_id", group="source", claimed=claimed)
    return merkle.verify(manifest).withColumnRenamed("key", "doc_id")


@register("op13_conversation_repair")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    _, found = turns.repair(turns.damage(conversations))
    ids = conversations.select("conv_id").distinct().withColumn("conv", turns.conv_key(F.col("conv_id")))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(found, "conv", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
