"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    guess_cost, licenses, merge_counts, page_wrappers, pairwise_quality, repetition, sentence_pieces, simhash_gph, source_divergence,
    spaced_seeds, suffix_blocks, token_links, trie_bpe,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_pairwise_quality(spark: SparkSession, sf: str) -> DataFrame:
    return pairwise_quality.scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op2_page_wrappers(spark: SparkSession, sf: str) -> DataFrame:
    return page_wrappers.extract(table(spark, sf, "pages").select("page_id", "url", "html"))


def op3_spaced_seeds(spark: SparkSession, sf: str) -> DataFrame:
    return spaced_seeds.pairs(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op4_simhash_pigeonhole(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_gph.fingerprint_rows(table(spark, sf, "documents"))


def op5_suffix_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_blocks.digests(table(spark, sf, "documents"))


def op6_guess_cost(spark: SparkSession, sf: str) -> DataFrame:
    return guess_cost.digests(table(spark, sf, "documents"))


def op7_licence_cosine(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.documents_licences(table(spark, sf, "documents"))


def op8_trie_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return trie_bpe.digests(table(spark, sf, "documents"))


def op9_repetition(spark: SparkSession, sf: str) -> DataFrame:
    return repetition.verdicts(table(spark, sf, "documents"))


def op10_merge_counts(spark: SparkSession, sf: str) -> DataFrame:
    return merge_counts.count_tokens(table(spark, sf, "documents").select("doc_id", "text"), keep=["doc_id"])


def op11_token_links(spark: SparkSession, sf: str) -> DataFrame:
    return token_links.digests(table(spark, sf, "documents"))


def op12_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return source_divergence.divergences(table(spark, sf, "documents"))


def op13_sentence_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return sentence_pieces.digests(table(spark, sf, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_pairwise_quality, op2_page_wrappers, op3_spaced_seeds, op4_simhash_pigeonhole, op5_suffix_blocks,
        op6_guess_cost, op7_licence_cosine, op8_trie_bpe, op9_repetition, op10_merge_counts, op11_token_links, op12_source_divergence, op13_sentence_pieces,
    )
}
ORACLES: dict[str, str] = {"op7_licence_cosine": licenses.ORACLE, "op12_source_divergence": source_divergence.ORACLE}
