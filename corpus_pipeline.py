"""A corpus pipeline: classify, deduplicate exactly and nearly, mix, pack.

Every stage works on what the one before it kept; all but the last return the
columns of ``documents``, extra ones too, whatever they are called. In every
stage a null text counts as an empty one, identifiers may be null or repeated
(each row is a document of its own, told by its place in the files), texts are
read whole however long, and an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlespark.llm import exact_dedup, jaccard_join, kernel_classifier, mixing, packing
from candlespark.llm.staging import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Empty and null texts are scored as any other; equal texts score alike.
    Without labels of both kinds every document is accepted.
    """
    return kernel_classifier.accepted_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts: the longest original, then the smallest doc_id.

    A null doc_id comes last; of rows equal in both, any one stays. All empty,
    null and blank texts are one group.
    """
    return exact_dedup.kept_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each component of near duplicates: five-word shingles, a similarity of 0.8.

    The smallest doc_id stays. Texts without a word are linked with nothing and stay.
    """
    return jaccard_join.kept_documents(docs, jaccard_join.Rule(words=5, num=80, den=100))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document that is taken twice is there twice.

    A null source is a source of its own. Documents without words have no size
    and are never taken.
    """
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and batches of the mix: a row for each document that is there, copies too.

    Rows equal in doc_id and length take places next to each other.
    """
    return packing.pack(docs)


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("mixing sources", mix), ("packing", packed)]

#: The classifier is learnt, which SQL can't express; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
