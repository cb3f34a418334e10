"""The corpus pipeline: from raw documents to packed training sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from finfacts.llm.common import stored, table
from finfacts.llm.grade_classifier import fit_documents, graded, select_documents
from finfacts.llm.line_dedup import dedup_lines
from finfacts.llm.packing import pack_documents
from finfacts.llm.quality_rules import rule_quality
from finfacts.llm.simhash_dedup import dedup_near


# Bytes of text that a task looks up at once; its worker still holds memory of earlier stages.
LOOKED_UP = 2 << 20


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the ratings of these documents, selects."""
    return select_documents(docs, fit_documents(docs, graded(table(spark, sf_dir, "labels"))))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that are too common in their source."""
    return rule_quality(docs).filter("kept").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that two of them share, but for the first occurrence.

    So of copies of a document one keeps its text.
    """
    return dedup_lines(docs, min_docs=2, keep_first=True).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity of 0.8 or more."""
    return dedup_near(docs, size=5, min_similarity=0.8)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents and their places in sequences."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False, chunk=LOOKED_UP)


STAGES = [
    ("quality_classifier", classify),
    ("quality_rules", apply_rules),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("best_fit_packing", pack),
]

# No SQL: the classifier is fitted, and packing follows the file of a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
