"""From raw documents to token ids: reject, deduplicate, decontaminate, redact, encode.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from telewarden.llm import bpe, decontamination, pii, quality, simhash
from telewarden.llm.queries import table, vocabulary_path
from telewarden.session import Staging


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels, does not reject."""
    return quality.accepted(docs, quality.fit(spark, docs, table(spark, sf_dir, "labels")))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    return simhash.keep_one(spark, docs, shingle=3, distance=3)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.clean(spark, docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by labels."""
    return pii.redact(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their count, and hashes of the ids and of what they decode to."""
    encoded = bpe.encode(spark, docs, vocabulary_path(), decoded=True)
    return bpe.digests(encoded, "doc_id", "ids")


STAGES = [
    ("quality classifier", quality_stage),
    ("simhash near-dedup", dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("bpe", bpe_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    staging = Staging(spark)
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = staging(stage(spark, docs, sf_dir), f"stage_{place}")
    return docs


#: The stages cannot be expressed in SQL; tests hold them against brute force.
ORACLE_SQL = None
