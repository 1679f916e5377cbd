"""A corpus pipeline: quality rules, near-duplicates, decontamination, secrets, tokens.

Each stage takes (spark, docs, table folder) and gives documents again, the last one tokens. ``run`` writes
every stage's rows to the shared folder and reads them again as the next one's documents.

Rows are judged one by one, not by their ids: null and repeated ids, repeated rows and further columns (which all stages
but the last hand on) are allowed. Null and empty texts fail the quality rules; texts of any length are read whole. Empty
tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm import guess_cost, repetition, simhash_gph, spaced_seeds, trie_bpe
from hirelens.llm.common import prepare, table, written

# Near copies: fingerprints of three-word shingles that differ in three bits or fewer.
NEAR = {"size": 3, "tau": 3}


def quality_rules(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Documents that pass the repetition rules."""
    return repetition.apply_rules(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id, an id's rows by their texts, null ids last."""
    return simhash_gph.keep_one(docs, **NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Documents without a passage of the benchmark; a text's copies are judged alike."""
    return spaced_seeds.decontaminate(docs, table(spark, sf, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Documents with their secrets replaced by a mark, and n_chars, if there is such a column, as the text is then."""
    clean = guess_cost.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """doc_id, n_tokens, ids and the decoded text of what is left."""
    coded = trie_bpe.encode(docs.select("doc_id", "text"), keep=["doc_id"])
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("redact_secrets", redact_secrets),
    ("encode", encode),
]

# The stages' hashing, clustering and merging are beyond SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
