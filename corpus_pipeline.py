"""A corpus pipeline: quality, boilerplate lines, near copies, repeated passages, packing.

Each stage takes what the one before kept, decides on all of it, and writes its result to the shared folder.
All but the last return the columns of ``documents``; where a stage changes a text, ``n_chars`` follows.

Defined results: every stage treats null and empty texts, repeated rows and null ids as its operator says; an
empty table gives an empty table. Very long texts pass whole, white space and repetitive ones too. Of equal texts the
smallest id stays, and of equal runs of sentences or words the first place in the order of ids. Columns beyond those of
``documents`` are not carried on.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import line_frequency, packing, parity_join, quality, sentence_spans
from tidemark.llm.common import table
from tidemark.session import discard, materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from this stage's own input."""
    docs = _documents(docs)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that too many pages of their source hold."""
    return _measured(line_frequency.drop_site_lines(_documents(docs)))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more on shingles of five words."""
    return parity_join.keep_one(_documents(docs), width=5, num=8, den=10)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that a run of sentences or words repeats from an earlier place."""
    return _measured(sentence_spans.drop_repeated_spans(_documents(docs), word_run=sentence_spans.WORD_RUN))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in sequences."""
    return packing.pack_documents(_documents(docs), public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_documents),
    ("site_lines", without_boilerplate),
    ("near_copies", without_near_copies),
    ("sentence_spans", without_repeats),
    ("packing", packed),
]

#: No stage but the second can be put in SQL: they learn, sketch, tokenise and pack.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; what a stage has read is deleted."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            discard(before)
        before = docs
    return docs
