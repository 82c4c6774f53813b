"""From raw documents to token ids: rules, classifier, SimHash near-duplicates, mixing, encoding.

Every stage takes the documents its predecessor kept and, but for the last,
returns rows of the same columns. ``run`` applies them to the table documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallywatch.llm import bpe, mixing, quality_model, quality_rules, simhash
from tallywatch.llm.common import documents, save_and_reload, table
from tallywatch.llm.queries import vocabulary_path


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that fail the base rules or diverge from their language."""
    return quality_rules.keep_good_documents(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the quality classifier scores below one half."""
    return quality_model.keep_good_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints at 2 or fewer differing bits link."""
    return simhash.keep_one_per_group(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix to target weights takes it."""
    return mixing.mix_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``source``, ``ids`` and ``n_tokens`` of each document."""
    return bpe.encode_documents(docs, vocabulary_path(), keep=("doc_id", "source"))


STAGES = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("SimHash near-dedup", near_duplicates),
    ("mixing", mixture),
    ("encoding", encoding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next stage reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = save_and_reload(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
