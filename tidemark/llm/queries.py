"""Registered queries of the llm operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bitslice, block_naming, jaccard, mixing, packing, piece_coding, preference, sharding, spelling, substring_dedup, toxicity, warc,
               whitening)
from .common import table


def op1_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = preference.numbered_turns(table(spark, sf_dir, "conversations"))
    return preference.preference_turns(*preference.swapped_reply_pairs(turns))


def op2_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % bitslice.QUERY_EVERY == 0)


def op4_best_two_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_induced_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op7_token_combination_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_hypergeometric_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op9_block_naming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = block_naming.exact_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_systematic_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_distinct_chunk_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_coding.encode_documents(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_preference_formatting, op2_warc_round_trip, op3_bit_sliced_top_k, op4_best_two_fit_packing, op5_toxicity_crf,
                           op6_induced_suffix_dedup, op7_token_combination_join, op8_hypergeometric_sharding, op9_block_naming_dedup, op10_systematic_mixing,
                           op11_distinct_chunk_coding, op12_spelling_variants, op13_embedding_whitening)
}

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {
    "op1_preference_formatting": preference.SQL,
    "op2_warc_round_trip": warc.SQL,
    "op3_bit_sliced_top_k": bitslice.SQL,
    "op9_block_naming_dedup": f"""
WITH t AS (SELECT doc_id, {LOWERED} AS low FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY low) AS keep_id, count(*) OVER (PARTITION BY low) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY low) AS kept, sha256(low) AS text_sha256 FROM t""",
    "op10_systematic_mixing": mixing.sql("documents"),
}
