"""A corpus pipeline: quality filter, exact and near deduplication, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as Parquet to the
shared scratch folder and reads it again as the next one's docs. All stages but the last return the columns
of documents; the last returns a row per packed piece."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stridelake.llm import exact_dedup, mixing, near_dedup, packing, quality_knn
from stridelake.llm.common import materialize, prepare, read


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least the threshold."""
    return quality_knn.good_documents(docs, quality_knn.model_of(spark, docs, sf_dir))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, the document with the smallest doc_id."""
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents in the amounts that the sources' weights ask for, repeated where a source is short."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document, with its place in a sequence of at most 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", drop_low_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: The classifier, consistent sampling and packing aren't expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(prepare(spark), sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
