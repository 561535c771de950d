"""The corpus pipeline: documents in, encoded training rows out.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geolake.llm import catalog, decontaminate, near_dedup, pii, toxicity
from geolake.llm.common import prepare, stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier chain, trained on the labelled
    ones, judges toxic."""
    prepare(spark)
    return toxicity.remove_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each near-duplicate group."""
    prepare(spark)
    return near_dedup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold ten consecutive words of a benchmark item."""
    prepare(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by format-preserving pseudonyms."""
    prepare(spark)
    return pii.pseudonymise(docs, catalog.pii_key(spark))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every text, packed, with their count."""
    prepare(spark)
    return catalog.encoded(docs).select("doc_id", "n_tokens", "ids")


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_copies), ("decontamination", drop_contaminated),
          ("pii", pseudonymise), ("bpe", encode)]

#: Trained models, hashing and merges: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each is written before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, name)
    return docs
