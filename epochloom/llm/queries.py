"""One query per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epochloom.llm.alignment import aligned_tokens, with_pair_counts
from epochloom.llm.bit_sliced import top_matches
from epochloom.llm.bpe_codec import bpe_decoded, bpe_encoded
from epochloom.llm.e8_dedup import near_vectors
from epochloom.llm.exact_dedup import exact_groups
from epochloom.llm.gru_lm import document_scores
from epochloom.llm.minhash_dedup import near_documents
from epochloom.llm.packing import packed_pieces
from epochloom.llm.quality import quality_scores
from epochloom.llm.resampling import resampled
from epochloom.llm.sharding import shuffled_shards
from epochloom.llm.simple8b import read_token_files, write_token_files
from epochloom.llm.suffix_dedup import repeats_removed
from epochloom.shared import materialise, shared_path

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text")


def _remainder(n: int) -> Column:
    """crc32 of the document's number as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_documents(spark, sf_dir)).drop("row_key")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe_encoded(_documents(spark, sf_dir), BYTE_RANKS, public_tokenizers.PATTERN)
    return bpe_decoded(tokens, BYTE_RANKS, public_tokenizers.PATTERN).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(_documents(spark, sf_dir), words_each=4, percent=80).drop("row_key")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    write_token_files(_documents(spark, sf_dir), path, WORD_BPE)
    return read_token_files(spark, path, checksum=True)


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = _documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(raw) + 16).cast("long").alias("size"), F.crc32(raw).alias("text_crc32")
    )
    return shuffled_shards(rows, 40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(_documents(spark, sf_dir), WORD_BPE).drop("ids")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_removed(_documents(spark, sf_dir))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"), held_out=_remainder(3) == 1)


def op10_gru_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_scores(_documents(spark, sf_dir), held_out=_remainder(5) == 1)


def op11_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_matches(_table(spark, sf_dir, "embeddings"), F.col("_id") % 50 == 0, k=5, scale=256)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark")).drop("n_words")


def aligned_digests(docs: DataFrame) -> DataFrame:
    """Counts of tokens, groups and links of each document, with a digest of its groups."""
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    found = aligned_tokens(docs, BYTE_BPE, PIECE_BPE).withColumn("groups_sha256", digest).drop("groups")
    return with_pair_counts(materialise(found, "aligned"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_digests(_documents(spark, sf_dir))


QUERIES = {
    "op1_lattice_dedup": op1_lattice_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_superminhash": op4_superminhash,
    "op5_token_files": op5_token_files,
    "op6_shards": op6_shards,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_quality": op9_quality,
    "op10_gru_scores": op10_gru_scores,
    "op11_bit_sliced_top_k": op11_bit_sliced_top_k,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_token_alignment": op13_token_alignment,
}
