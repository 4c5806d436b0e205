"""The corpus pipeline: documents in, kept and encoded documents out.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and is written and read again before the next one. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitelens.llm import bpe_codec, decontam, exact_dedup, minhash_dedup, quality
from sitelens.llm.common import materialize, prepare, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the compression classifier rejects. It is
    fitted on labelled rows of the stage's own input that aren't held out."""
    prepare(spark)
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    prepare(spark)
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at Jaccard 0.8 or more the smallest doc_id stays."""
    prepare(spark)
    return minhash_dedup.drop_near_copies(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that contain a benchmark item."""
    prepare(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded texts."""
    prepare(spark)
    return bpe_codec.encode_documents(docs)


STAGES = [
    ("quality", quality_classifier),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", decontamination),
    ("bpe", bpe_encoding),
]

# The classifier is fitted and the tokenizer is a library's: SQL can't express either.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
