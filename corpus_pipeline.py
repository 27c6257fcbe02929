"""From raw documents to packed training sequences: five stages, each written as Parquet and read by the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language, mixing, packing, simhash, suffixes
from tidemark.llm.common import ship, small_batches, stage, table, vocabulary


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops null texts and texts without a letter. The network's answer fills missing languages and corrects ones it is certain are wrong."""
    small_batches(spark)
    return language.keep_identified(docs, language.train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash class, the one with the smallest id."""
    small_batches(spark)
    return simhash.drop_near_duplicates(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 bytes or more that a document with a smaller id holds; n_chars follows the text. No row is dropped."""
    small_batches(spark)
    names = [f"c{i}" for i in range(len(docs.columns))]
    others = {c: n for c, n in zip(docs.columns, names) if c != "text"}
    carry = F.struct(F.col("text").isNull().alias("no_text"), *[F.col(f"`{c}`").alias(n) for c, n in others.items()])
    found = suffixes.remove_repeats(docs, keep_text=True, carry=carry)
    kept = {c: F.col(f"carried.{n}") for c, n in others.items()}
    kept["text"] = F.when(~F.col("carried.no_text"), F.col("kept_text"))
    if "n_chars" in docs.columns:
        kept["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    return found.select(*[kept[c].alias(c) for c in docs.columns])


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the target weights of its source ask for."""
    return mixing.take(docs)


def pattern_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of at most 4096 tokens; one row per piece."""
    small_batches(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), "word")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("source_mixing", source_mixing),
    ("pattern_packing", pattern_packing),
]

#: A trained network and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ship(spark), sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
