"""Registered queries of the corpus operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    decontamination,
    hard_negatives,
    line_frequency,
    packing,
    parity_join,
    quality,
    sentence_spans,
    small_world,
    spelling,
    suffixes,
    top_products,
    warc,
)
from tidemark.llm.common import table


def op1_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products.top_products(table(spark, sf_dir, "embeddings"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed_bytes(table(spark, sf_dir, "documents"))


def op5_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op6_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.link_components(table(spark, sf_dir, "documents"), width=3, num=90, den=100)


def op7_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentence_spans.drop_repeated_spans(docs)


def op8_small_world(spark: SparkSession, sf_dir: str) -> DataFrame:
    return small_world.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("host"), "text")
    return line_frequency.drop_site_lines(docs, host="host")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.word_counts(table(spark, sf_dir, "documents")))


def op12_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    # Every seventh label is made wrong, so that some true neighbours have another one.
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(hard_negatives.usable(vectors.withColumn("label", wrong)))


def op13_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontamination.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.contamination(hits)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pu_quality": op1_pu_quality,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_top_products": op3_top_products,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_warc_index": op5_warc_index,
    "op6_parity_join": op6_parity_join,
    "op7_sentence_spans": op7_sentence_spans,
    "op8_small_world": op8_small_world,
    "op9_bpe_round_trip": op9_bpe_round_trip,
    "op10_site_lines": op10_site_lines,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_angular_negatives": op12_angular_negatives,
    "op13_wu_manber": op13_wu_manber,
}
