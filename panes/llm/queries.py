"""Registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panes.session import scratch_path
from panes.sources.tables import table

from . import chat, embed, exact, kmeans, langid, lines, minhash, packing, quality, sharding, spm, structure, warc

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in 16 shards of near-equal bytes (law ``bytes``)."""
    shards = sharding.kd_shards(table(spark, sf_dir, "documents"), ["n_chars", "source", "lang", "doc_id"], shards=16)
    return shards.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op2_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all ``documents``: 2-word shingles, similarity of at least 0.8."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op3_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the document that stays for its text."""
    return exact.duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op4_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality score and whether it is kept."""
    return quality.score(table(spark, sf_dir, "documents"))


def op5_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 4096 tokens."""
    vocabulary = Path(tokenizer_file("word_bpe_49k.json")).read_text()
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary, end_id=2, capacity=4096)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` without the lines that at least 10 of them have."""
    kept = lines.drop_frequent_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_grid_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``embeddings`` with their links of cosine 0.98 or more within a label."""
    return embed.near_vectors(table(spark, sf_dir, "embeddings"), least=0.98)


def op8_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``pages`` written to archives, and the records read back."""
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path, least=1000)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations``, repaired at least cost and rendered."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op10_streaming_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The piece ids of all ``documents``, and the texts they decode to (as digests)."""
    model = Path(tokenizer_file("piece_bpe_32k.model")).read_bytes()
    encoded = spm.encode_texts(table(spark, sf_dir, "documents"), model, kind="bpe", decoded=True)
    return encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_hirschberg_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of ``conversations``, damaged, audited and repaired at least cost."""
    turns = table(spark, sf_dir, "conversations")
    found = structure.digests(structure.repair_structure(structure.damaged(turns))).withColumnRenamed("conv_id", "found_id")
    every = turns.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_hyperdimensional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op13_incremental_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector of ``embeddings`` with its cluster after five rounds and a last assignment."""
    found = kmeans.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed="2", dimensions=64)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"))


LLM_QUERIES: dict[str, Query] = {
    "op1_kd_shards": op1_kd_shards,
    "op2_hyperminhash": op2_hyperminhash,
    "op3_digest_index": op3_digest_index,
    "op4_weak_labels": op4_weak_labels,
    "op5_min_bin_slack": op5_min_bin_slack,
    "op6_line_runs": op6_line_runs,
    "op7_grid_order_join": op7_grid_order_join,
    "op8_warc_dictionary": op8_warc_dictionary,
    "op9_role_repair": op9_role_repair,
    "op10_streaming_viterbi": op10_streaming_viterbi,
    "op11_hirschberg_repair": op11_hirschberg_repair,
    "op12_hyperdimensional": op12_hyperdimensional,
    "op13_incremental_distances": op13_incremental_distances,
}
