"""Training-data pipeline: documents in, packed token sequences out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandwise.llm import exact_dups, mixing, near_dups, packing, toxicity
from strandwise.storage import discard, only_kept, stored


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted on the labelled rows of the corpus, doesn't call toxic."""
    documents, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit_on_labels(documents.select("doc_id", "text"), labels))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dups.without_copies(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return near_dups.without_near_duplicates(docs, k=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document comes as often as it is drawn."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs)


STAGES = [("toxicity", clean), ("exact dedup", unique), ("near dedup", distinct), ("mixing", mixed), ("packing", packed)]

#: No SQL expresses the severity model, so the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each one's rows written and read again. What a stage stored on its way, and the rows of
    the stage before it, are deleted as soon as its own rows are written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        with only_kept(spark) as keep:
            docs = keep(stored(stage(spark, docs, sf_dir)))
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
