"""From documents to packed sequences: each stage works on what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import language, near_dedup, packing, quality, sentences
from quayside.llm.store import table, written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality.keep_good(docs, quality.co_train(docs, table(spark, sf_dir, "labels")))


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned from them."""
    return language.keep_known(docs, language.learn(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.one_of_each(docs)


def no_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without sentences that another said first; ``n_chars`` follows the text."""
    found = sentences.remove_repeats(docs)
    left = {"text": F.col("text"), "n_chars": F.char_length("text").cast("bigint")}
    return found.select(*(left[c].alias(c) if c in left else F.col(f"row.`{c}`") for c in docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", good_documents),
    ("language", known_languages),
    ("near duplicates", one_of_each),
    ("substrings", no_repeats),
    ("packing", packed),
]

#: Tokenizers and classifiers cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
