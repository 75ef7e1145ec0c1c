"""One registered query per operator, with production parameters, over whole tables."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crispstar.llm import bpe, exact_dedup, merkle, mixing, prefix_trie, simhash, substring_dedup, surrogates, syncmers, token_shards, topk, toxicity, virtual_slots
from crispstar.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

# The key of the permutation and of the surrogates; a deployment passes its own.
KEY = b"crispstar"
# How texts are split before the merges of the rank files; a property of those files.
RANK_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RANK_END = 50_256


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    spec = importlib.util.find_spec("public_tokenizers")
    return str(Path(spec.origin).parent / name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every text as token ids in keyed training order, read back from the shards it is written to."""
    out = scratch_path(spark, "token-shards")
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    token_shards.write_shards(_table(spark, folder, "documents"), out, ranks, RANK_PATTERN, RANK_END, KEY)
    return token_shards.digests(token_shards.read_shards(spark, out))


def op2_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return surrogates.replace_personal(_table(spark, folder, "documents"), KEY)


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, folder, "documents"))


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeated(_table(spark, folder, "documents"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.held_out_toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op6_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    # Alone in its workers it may keep more words than as a stage of the pipeline.
    return bpe.round_trip(_table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"), cached=256 << 20)


def op8_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_components(_table(spark, folder, "documents"))


def op9_virtual_slot_shards(spark: SparkSession, folder: str) -> DataFrame:
    return virtual_slots.shard_by_slots(_table(spark, folder, "documents"), scratch_path(spark, "slot-map"))


def op10_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.tampered_manifest(_table(spark, folder, "documents"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, folder, "conversations"))


def op13_syncmer_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return syncmers.syncmer_fingerprints(_table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_token_shards, op2_pii_surrogates, op3_exact_dedup, op4_substring_dedup, op5_toxicity,
        op6_exact_top_k, op7_bpe_round_trip, op8_simhash_near_dedup, op9_virtual_slot_shards, op10_source_mixing,
        op11_merkle_manifest, op12_prefix_trie, op13_syncmer_fingerprints,
    )
}
