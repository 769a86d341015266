"""The registered query of each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (
    decontamination,
    fingerprints,
    hard_negatives,
    language,
    near_dedup,
    neighbours,
    packing,
    perspectives,
    quality,
    repeats,
    resampling,
    sentencepiece,
    sentences,
)
from quayside.llm.store import table


def op1_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, sf_dir, "documents"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op3_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.co_train(docs, table(spark, sf_dir, "labels")))


def op5_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentences.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "n_sentences", "n_removed", "text")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op8_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = perspectives.perspectives(table(spark, sf_dir, "conversations"))
    return found.withColumn("mask", F.array_join(F.transform("mask", lambda n: n.cast("string")), ","))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.cut_repeats(table(spark, sf_dir, "documents"))
    return cut.select(*repeats.digests(), repeats.kept_text().alias("text"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", "n_features", "weight", "score", "rank")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_spot_signatures,
        op2_nearest_neighbours,
        op3_merge_dropout,
        op4_quality,
        op5_sentence_spans,
        op6_packing,
        op7_near_duplicates,
        op8_perspectives,
        op9_repeats,
        op10_language,
        op11_resampling,
        op12_hard_negatives,
        op13_decontamination,
    )
}
