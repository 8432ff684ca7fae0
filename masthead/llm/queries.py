"""The registered queries: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masthead.llm import (
    alignment,
    exact,
    jaccard,
    language,
    neighbours,
    packing,
    passages,
    pieces,
    pii,
    preference,
    quality,
    secret_scan,
    spelling,
)
from masthead.llm.common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer's file on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def word_tokenizer() -> str:
    return Path(tokenizer_path("word_bpe_49k.json")).read_text()


def op1_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table marks no preference. Every conversation with an assistant turn is taken as chosen; its rejected counterpart has
    the last assistant turn of its neighbour (2n and 2n + 1) instead of its own, or an empty one. Its id is -1 - conv_id.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    last = turns.filter(F.col("role") == preference.TRAINED_ROLE).groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("last.text").alias("other"))
    swaps = last.select("conv_id", F.col("last.turn").alias("at")).join(other, "conv_id", "left")
    replaced = (F.col("turn") == F.col("at")) & (F.col("role") == preference.TRAINED_ROLE)
    rejected = turns.join(swaps, "conv_id").select(
        (-1 - F.col("conv_id")).alias("conv_id"),
        "turn",
        "role",
        F.when(replaced, F.coalesce("other", F.lit(""))).otherwise(F.col("text")).alias("text"),
    )
    pairs = last.select(F.col("conv_id").alias("pair_id"), F.col("conv_id").alias("chosen_id"), (-1 - F.col("conv_id")).alias("rejected_id"))
    return preference.preference_pairs(turns.unionByName(rejected), pairs)


def op2_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, docs.filter(~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op3_nb_support_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    found = quality.score(table(spark, sf_dir, "documents"), labels)
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_adaptive_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, sf_dir, "documents"))


def op5_robust_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.linked_vectors(table(spark, sf_dir, "embeddings"))


def op6_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_large_item_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_tokenizer())


def op8_collinear_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op9_information_theoretic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op10_batched_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = pieces.read_pieces(tokenizer_path("piece_bpe_32k.model"))
    found = pieces.encode(table(spark, sf_dir, "documents"), vocabulary)
    return found.select("doc_id", F.size("ids").alias("n_ids"), "ids_crc32", "round_trip")


def op11_kd_letter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.count_words(table(spark, sf_dir, "documents")))


def op12_recursive_decoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op13_interval_coalescing(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = Path(tokenizer_path("byte_bpe_50k.json")).read_text()
    second = Path(tokenizer_path("piece_bpe_32k.model")).read_bytes()
    return alignment.aligned_documents(table(spark, sf_dir, "documents"), first, second)


def registered() -> dict[str, Query]:
    every = (
        op1_preference_pairs,
        op2_cross_parsing,
        op3_nb_support_vectors,
        op4_adaptive_prefix_join,
        op5_robust_pruned_graph,
        op6_chunk_recipes,
        op7_large_item_packing,
        op8_collinear_chains,
        op9_information_theoretic,
        op10_batched_viterbi,
        op11_kd_letter_counts,
        op12_recursive_decoding,
        op13_interval_coalescing,
    )
    return {f.__name__: f for f in every}
