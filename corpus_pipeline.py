"""A pipeline over the documents table: quality rules, near-duplicates, mixing, and encoding into pieces."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import mixing, near_copies, quality, queries, sentencepieces
from ledgerloom.llm.shared import new_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail go; so do documents that fail the base rules or lose too much."""
    return quality.keep_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8 or more) stays."""
    return near_copies.keep_one(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, once or more."""
    return mixing.take(docs)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded texts, as doc_id, n_tokens and their hashes."""
    return queries.pieces_digest(sentencepieces.encode_pieces(docs.select("doc_id", "text"), public_tokenizers.path(queries.PIECES)))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("source_mixing", source_mixing), ("piece_encoding", piece_encoding)]
#: SimHash components, Pareto sampling and piece encoding are not for SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each result written to the shared folder and read as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(path := new_folder(spark, name))
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
