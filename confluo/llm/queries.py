"""Registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from confluo.llm import bpe, collocations, jaccard, langid, lm, merkle, neighbours, packing, quality, repeats, token_counts, toxicity, url_filter
from confluo.llm.common import table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_and_redact(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.evaluate(table(spark, sf_dir, "documents"), depth=6)


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents")).drop("t", "component")


def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.spans(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.line_ends_lost(table(spark, sf_dir, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_best_fit_packing, op2_language_id, op3_url_filters, op4_token_counts, op5_quality_rules, op6_embedding_near_dedup, op7_toxicity, op8_bpe_encoding, op9_lm_scoring, op10_ngram_jaccard_join, op11_suffix_array_dedup, op12_merkle_manifest, op13_phrase_collocations)}

ORACLE_SQL: dict[str, str] = {"op3_url_filters": url_filter.SQL, "op5_quality_rules": quality.SQL, "op12_merkle_manifest": merkle.SQL, "op13_phrase_collocations": collocations.SQL}
