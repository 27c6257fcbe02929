"""The registered queries of this package, and DuckDB statements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import attention, cap_filters, dual_tree, four_russians, language, mixing, packing, seed_extend, simhash, suffixes, syncmers, token_files, toxicity
from tidemark.llm.common import table, vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


ORACLES["op2_source_mixing"] = mixing.ORACLE


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), "byte")


@query
def op9_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), "word")


@query
def op8_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edit_check(table(spark, sf_dir, "documents"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language.fold("doc_id", 5) == 0
    network = language.train(docs.where(~held_out))
    return language.identify(docs, network).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op10_deobfuscated_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language.fold("doc_id", 4) == 2
    model = toxicity.train(docs.where(~held_out), table(spark, sf_dir, "labels"))
    found = toxicity.scores(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


@query
def op4_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language.fold("doc_id", 7) == 2
    found = attention.score(docs, docs.where(~held_out), vocabulary("byte_bpe_50k.json"))
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row whose id is divisible by 100 against all rows; labels moved by one where the id is divisible by 7."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return four_russians.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


ORACLES["op13_hard_negatives"] = four_russians.ORACLE


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of all for every benchmark item."""
    return dual_tree.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), most=20)


ORACLES["op11_ranked_search"] = dual_tree.ORACLE


@query
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents left after passages of 50 words or more that a smaller id holds are cut."""
    return seed_extend.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLES["op12_substring_dedup"] = seed_extend.ORACLE
