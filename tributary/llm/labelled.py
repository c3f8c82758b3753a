"""A bounded sample of labelled documents to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import fold, written


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, max_examples: int) -> DataFrame:
    """(doc_id, label, text) of at most `max_examples` labelled documents, as a written table.

    Only documents whose crc32 fold is not 0 are used. The sample takes the smallest hashes of
    the ids, so it does not depend on the order of rows. Rows without id or label are left
    out, of several labels of one id the largest counts, and of several texts the smallest.
    Its bound makes the sample's ids safe to broadcast, so no text is shuffled to find them.
    """
    usable = labels.select("doc_id", F.col(label).cast("int").alias("label"))
    usable = usable.where("doc_id IS NOT NULL AND label IS NOT NULL").where(fold("doc_id") != 0)
    ids = usable.groupBy("doc_id").agg(F.max("label").alias("label"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)
    ids = written(ids, "labelled-ids")
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(ids), "doc_id")
    return written(found.groupBy("doc_id", "label").agg(F.min("text").alias("text")), "labelled-sample")
