"""Corpus pipeline: quality rules, near duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read back as the next stage's ``docs``. All but the last return the
columns of ``documents``. Stages call the operators of ``traitlens.llm``; nulls,
empty texts, repeated rows and further columns are handled there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from traitlens.llm import decontam, jaccard_join, packing, pii, repetition
from traitlens.llm.common import table, written
from traitlens.llm.registry import tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return repetition.keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that of the least id."""
    return jaccard_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by ``[KIND]`` and ``n_chars`` counted anew."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 ids, sources mixed in proportion."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("personal_data", personal_data), ("packing", pack)]

#: Suffix arrays, similarity classes and tokenizers are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
