"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from traitlens.llm import (decontam, html_text, jaccard_join, kneser_ney, license_scan, packing, phrases,
                           piece_encoding, pii, prefix_trie, repetition, url_filter, warc)
from traitlens.llm.common import shared_path, table


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition counts and verdict of every document."""
    return repetition.quality_rules(table(spark, sf_dir, "documents"))


def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document under a model of the trusted ones."""
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back; equal payloads are revisits."""
    return warc.round_trip(table(spark, sf_dir, "pages"), shared_path(spark, "warc"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in windows of 2048 ids, sources mixed in proportion to their tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and the window's similarity."""
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own and inherited licence of every document."""
    templates = spark.createDataFrame(license_scan.TEMPLATES, "name string, text string")
    return license_scan.scan(table(spark, sf_dir, "documents"), templates, license_scan.document_path())


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document."""
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the fixed rule list for every page's URL."""
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    return url_filter.url_filter(table(spark, sf_dir, "pages"), rules)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct prefix of the rebuilt conversations, with its members, leaves and savings."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document under the merge-type vocabulary, and the text decoded from them, as digests."""
    return piece_encoding.digests(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_repetition, op2_kneser_ney, op3_warc, op4_jaccard_join, op5_packing, op6_html_text, op7_decontamination,
        op8_license_scan, op9_pii, op10_url_filter, op11_prefix_trie, op12_sentencepiece, op13_phrases)}


def oracle_sql() -> dict[str, str]:
    return {"op3_warc": warc.ORACLE, "op10_url_filter": url_filter.ORACLE, "op11_prefix_trie": prefix_trie.ORACLE,
            "op13_phrases": phrases.ORACLE}
