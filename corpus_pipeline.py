"""From raw documents to token ids: reject, deduplicate, decontaminate, mix, encode.

Each stage takes the documents that its predecessor kept and returns those it keeps, with
the same columns; the last returns what the written shards say of each document. Between
stages documents are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearthlake.llm import decontam, jaccard, mixing, token_ids, toxicity
from hearthlake.session import Staging


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity scorer accepts; it learns from the labels of documents still here."""
    return toxicity.accepted_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones."""
    return jaccard.one_of_each(Staging.lasting(spark), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items."""
    return decontam.clean_documents(Staging.lasting(spark), docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document comes as often as the mix takes it."""
    return mixing.mixed_documents(Staging.lasting(spark), docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mix, in shards, as read back."""
    return token_ids.token_output(Staging.lasting(spark), docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("jaccard", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

#: The scorer and the tokenizer have no SQL form; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging, docs = Staging.lasting(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staging.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
