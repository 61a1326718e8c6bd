"""The operators applied to whole tables: one query each, and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from hearthlake.llm import decontam, jaccard, language, mixing, neighbours, pii, search, secrets, token_counts, token_ids, toxicity, warc, whitening
from hearthlake.llm.registry import ORACLES, QUERIES, query, table
from hearthlake.session import Staging

__all__ = ["ORACLES", "QUERIES"]


@query("op5_secrets")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(Staging.lasting(spark), table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op6_neighbours")
def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(Staging.lasting(spark), table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@query("op7_jaccard_join", jaccard.SQL)
def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_documents(Staging.lasting(spark), table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op8_source_mix", mixing.SQL)
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(Staging.lasting(spark), table(spark, sf_dir, "documents", "doc_id", "text", "source"))


@query("op1_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(Staging.lasting(spark), table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op2_warc", warc.SQL)
def warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(Staging.lasting(spark), table(spark, sf_dir, "pages", "page_id", "url", "html"))


@query("op3_decontamination", decontam.SQL)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontam.contamination(Staging.lasting(spark), documents, benchmark)


@query("op4_token_ids")
def token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.token_output(Staging.lasting(spark), table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op9_language")
def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


@query("op10_toxicity")
def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic")
    return toxicity.toxicity(documents, labels)


@query("op11_lexical_search", search.SQL)
def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, items = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    return search.ranked_documents(Staging.lasting(spark), documents, items)


@query("op12_token_counts")
def counted_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(Staging.lasting(spark), table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op13_whitening")
def whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_report(Staging.lasting(spark), table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
