"""The corpus queries by name, and the SQL that each is checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldweave.llm import (
    debruijn, licenses, lm, minhash, mixing, packing, phrases, pieces, preferences, radix, toxicity, vectors, whitening,
)
from fieldweave.llm.common import read
from fieldweave.llm.sql import SQL  # noqa: F401 - read by the entry


def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return radix.exact_groups(read(spark, folder, "documents")).drop("row")


def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents")).drop("row")


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(read(spark, folder, "documents")).drop("spans")


def preference_pairs(spark: SparkSession, folder: str) -> DataFrame:
    pairs = preferences.format_pairs(preferences.retold(read(spark, folder, "conversations")))
    text = lambda side: F.array_join(F.transform(side, lambda s: s.text), "")
    return pairs.select(
        "pair_id", "n_prompt_turns", "n_chosen_turns", "n_rejected_turns", "prompt",
        text("chosen").alias("chosen_text"), preferences.mask(F.col("chosen")).alias("chosen_mask"),
        text("rejected").alias("rejected_text"), preferences.mask(F.col("rejected")).alias("rejected_mask"))


def near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_groups(read(spark, folder, "documents")).drop("text_key")


def near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_groups(read(spark, folder, "embeddings"))


def packed(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return toxicity.scored(docs, toxicity.learn(docs, read(spark, folder, "labels")))


def lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score_texts(read(spark, folder, "documents"))


def shared_passages(spark: SparkSession, folder: str) -> DataFrame:
    return debruijn.shared_passages(read(spark, folder, "documents")).drop("spans")


def encoded_pieces(spark: SparkSession, folder: str) -> DataFrame:
    rows = pieces.encode_texts(read(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("last_byte"))


def whitened(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(read(spark, folder, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(read(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity_scores,
    "op2_preference_pairs": preference_pairs,
    "op3_packing": packed,
    "op4_lm_scores": lm_scores,
    "op5_license_scan": license_scan,
    "op6_exact_dedup": exact_dedup,
    "op7_source_mix": source_mix,
    "op8_near_dedup": near_dedup,
    "op9_near_vectors": near_vectors,
    "op10_shared_passages": shared_passages,
    "op11_pieces": encoded_pieces,
    "op12_whitening": whitened,
    "op13_collocations": collocations,
}
