"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words that differ by one inserted, deleted or replaced code point, the shorter (of equal lengths the
smaller) one contributes two disjoint chunks, its halves, and the other all its grams of their lengths with
their places. One edit leaves a chunk whole, and that chunk stands in the longer word at the same place, or one
further if the edit is before it: the chunk meets grams within shift one, and candidates are verified by their
edit distance. Grams at a place that no single edit can produce are not sent.

A common half (an ending, say) would gather a large group. So the rule is applied once more to the half with the
edit: one of its own two halves is whole as well and is part of the join key. Groups then agree in three
quarters of their letters at known places.

Occurrences are counted per task before the shuffle, so a frequent word arrives once from each. Forms have at
least ``RATIO`` times the occurrences of their words, so that a chain of forms ends after few steps; the roots
are found by doubling the steps.

Defined results: null and empty texts have no words. A null document id counts as the text ``null``. Words may
have any length; very long texts are read piece by piece. Repeated rows count as often as they stand there. Only
the named columns are read, so others cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches
from tidemark.llm.wordlists import kept_bytes, word_lists
from tidemark.session import discard, materialize

#: Code points and occurrences of a word at least; how many times a word's occurrences its form has.
MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
#: Of the (document, word) pairs, by their CRC-32, one in so many loses a code point.
SLIP_EVERY = 31
#: Bytes of distinct words that a task holds before it sends their counts.
HELD_BYTES = 16 << 20
WORD_BYTES = kept_bytes("abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100))))


def slipped(word: bytes, before: int, every: int) -> bytes:
    """The word (Latin-1) as its document has it: a code point is missing where ``every`` divides the CRC-32.

    ``before`` is the CRC-32 of what stands before the word.
    """
    h = crc32(word if word.isascii() else word.decode("latin-1").encode("utf-8"), before)
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
    slip_every: int = SLIP_EVERY,
) -> DataFrame:
    """``word, n``: words of at least ``min_length`` code points that occur ``min_count`` times or more."""

    def sent(counts: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = Counter(), 0
        for batch in batches:
            for doc, data in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                before = crc32(f"{doc}:".encode())
                # What Latin-1 lacks becomes a question mark, and so parts words.
                for words in word_lists(data.as_py().encode("latin-1", "replace"), WORD_BYTES):
                    for word, n in Counter([w for w in words if len(w) >= min_length]).items():
                        word = slipped(word, before, slip_every)
                        if len(word) >= min_length:
                            if word not in counts:
                                held += len(word) + 100
                            counts[word] += n
                    if held > HELD_BYTES:
                        yield sent(counts)
                        counts, held = Counter(), 0
        yield sent(counts)

    bound_batches(docs.sparkSession)
    doc = F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).alias("doc_id")
    found = docs.select(doc, F.col(text).alias("text")).where("text is not null").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _edge(length: Column, quarter: int) -> Column:
    """Where a quarter (0 to 4) of a word of that length begins: the halves, each cut in two."""
    half = F.floor(length / 2)
    return [F.lit(0), F.floor(half / 2), half, half + F.floor((length - half) / 2), length][quarter].cast("int")


def _signatures(words: DataFrame, shift: int, min_length: int) -> DataFrame:
    """``key, cut`` beside each word: what it shares with a partner shorter by ``shift`` that differs in one quarter.

    The key names the partner's length and the quarter and holds the chunk and the part of the other half that
    stay whole: those before the quarter at their own place, those after it at the place moved by ``shift``.
    """
    length = F.length("word") - shift
    made = [
        F.struct(
            F.xxhash64(
                length, F.lit(q), F.substring("word", F.lit(1), _edge(length, q)), F.substring("word", _edge(length, q + 1) + shift + 1, F.length("word"))
            ).alias("key"),
            _edge(length, q).alias("cut"),
        )
        for q in range(4)
    ]
    rows = words.where(length >= min_length).select("word", "n", F.explode(F.array(*made)).alias("s"))
    return rows.select("s.key", "s.cut", "word", "n")


def near_words(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``word, n, other, other_n``: every pair of ``words`` that differ by one edit, once."""
    chunks = _signatures(words, 0, min_length)
    grams = chunks.drop("cut").union(_signatures(words, 1, min_length).drop("cut"))
    grams = grams.select(F.col("key").alias("k"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    rest = F.substring("word", F.col("cut") + 1, F.length("word"))
    moved = F.length("other") - F.length("word")
    # A pair that agrees but for any of several quarters (a letter doubled at their edge) counts at the first.
    first = (F.col("cut") == 0) | (rest != F.substring("other", F.col("cut") + 1 + moved, F.length("other")))
    ordered = (moved > 0) | (F.col("word") < F.col("other"))
    pairs = chunks.join(grams, F.col("key") == F.col("k")).where(ordered & first & (F.levenshtein("word", "other", 1) == 1))
    return pairs.select("word", "n", "other", "other_n")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for words that have a form: the last of their chain, by steps of doubled length."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("w"), F.col("root").alias("further"))
        step = at.join(on, F.col("root") == F.col("w"), "left")
        if step.where("further is not null").isEmpty():
            return at
        before, at = at, materialize(step.select("word", F.coalesce("further", "root").alias("root")), "roots")
        discard(before)


def spelling_variants(words: DataFrame, ratio: int = RATIO, min_length: int = MIN_LENGTH) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of counted words (each once, of ``min_length`` code points or more).

    A word's form is its near word of most occurrences (ties: the first in code-point order) if these are at
    least ``ratio`` times its own; the root follows the forms to the last.
    """
    held = materialize(words.select("word", "n"), "words")
    pairs = near_words(held, min_length)
    ways = F.array(F.struct("word", "other", "other_n"), F.struct(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    near = pairs.select(F.explode(ways).alias("p")).select("p.*").groupBy(F.col("word").alias("w"))
    best = near.agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("b"))
    best = best.select("w", "n_near", F.col("b.other").alias("near"), (-F.col("b.m")).alias("near_n"))
    formed = F.col("near_n") >= ratio * F.col("n")
    rows = materialize(
        held.join(best, F.col("word") == F.col("w"), "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("near")).alias("form"), F.when(formed, F.col("near_n")).alias("form_n"),
        ),
        "variants",
    )
    discard(held)
    roots = _roots(rows.where("form is not null")).select(F.col("word").alias("w"), "root")
    return rows.join(roots, F.col("word") == F.col("w"), "left").select(*rows.columns, F.coalesce("root", "word").alias("root"))
