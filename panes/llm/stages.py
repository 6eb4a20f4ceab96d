"""Stages of the corpus pipeline: each an operator applied to documents."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact, minhash, packing, quality
from .queries import tokenizer_file


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those the quality classifier rejects."""
    return quality.drop_bad(docs)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those whose text another one has (exact dedup)."""
    return exact.drop_duplicates(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of at least 0.8."""
    return minhash.drop_near_duplicates(docs, width=5, percent=80)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of at most 4096 tokens."""
    vocabulary = Path(tokenizer_file("word_bpe_49k.json")).read_text()
    pieces = packing.pack(docs, vocabulary, end_id=2, capacity=4096)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))
