"""A training corpus from the documents table: reject toxic and poor documents, keep one of each group of near
duplicates, pack what is left into sequences.

Edge cases, by stage. Null and empty texts: not toxic (the model's bias alone, below one half), but poor, as they have no
words, so none comes to the later stages; these would keep each of them and pack it as its end id alone. Very long texts
are judged, compared and encoded whole, each by one task. Repeated rows: each is judged, one of a group stays; of ties
the smallest id. Empty tables give empty results. Columns beyond those of documents, whatever their names, pass through
all stages but the last, which returns its own. Null ids are ids of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from confluo.llm import jaccard, packing, quality, toxicity
from confluo.llm.common import fold, scratch, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled documents outside fold 0 of 5, doesn't call toxic."""
    learn = fold("doc_id", 5) != 0
    model = toxicity.train(docs.where(learn), table(spark, sf_dir, "labels").where(learn))
    return toxicity.reject(docs, model)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequences."""
    return packing.pack(docs)


STAGES = [("toxicity", toxic), ("quality_rules", good), ("ngram_jaccard_join", distinct), ("best_fit_packing", packed)]

#: SQL can express neither the classifier nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = scratch(docs)
    return docs
