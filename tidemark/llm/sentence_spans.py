"""Substring dedup by sliding sentence spans.

Runs of consecutive sentences are hashed; of equal runs the first, by document id and place, stays, and
what any other one covers is removed. Runs slide by size: from and up to every sentence the shortest run of two
sentences or more with ``min_words`` words. They cover every repeated run of two whole sentences or more that has
``min_words`` words. With ``span`` every run of that many sentences is taken instead.

Sentences are hashed once, and a run's hash comes from running sums over them, so it costs the same whatever its length.

``word_run`` adds, for passages that hold few whole sentences, runs of so many words wherever sentences end, at the least
hash of each ``WINDOW`` successive places (winnowing; Schleimer, Wilkerson and Aiken 2003). Each repeated passage
of ``word_run + WINDOW - 1`` words holds one, and at most ``WINDOW - 1`` words at either end of a passage stay. These may
cut sentences.

Defined results: sentences end at ``.``, ``!``, ``?`` before white space and at line ends, and are
compared in lower case with white space collapsed. A text of one sentence is one run, and so is a text with fewer than
``span`` sentences. Runs below ``min_words`` words are no evidence and stay. A null text stays null and an empty one
empty, with 0 sentences; a text of white space has one sentence and no run. Very long texts take time and memory in
proportion. A null id comes before all others. Rows with equal id and text are one
document: they do not remove each other, and each row gets the same result. Equal ids with different
texts are ordered by a hash of the text. ``n_removed`` counts sentences that went as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import Memory, map_arrow, release, unpacked, whole_row
from tidemark.llm.hashing import span_hashes
from tidemark.session import discard, materialize

#: Words in a run at least.
MIN_WORDS = 12
#: Words of a run that need not end with a sentence, and successive places of which one is hashed.
WORD_RUN, WINDOW = 24, 12
#: Places from here on are numbers of words, below of sentences.
_WORDS_FROM = 1 << 30

# White space before a line end is part of the sentence that ends there, so only what follows it is matched; a
# pattern that matched both sides would take quadratic time on white space.
_BREAK = re.compile(r"[.!?]\s+|\n\s*")
_WORD = re.compile(r"\S+")
_word_hash = Memory(lambda word: blake2b(word.encode(), digest_size=16).digest())


def sentence_bounds(text: str) -> list[tuple[int, int]]:
    """(start, end) of each sentence; each end is the next start, so the parts join to the text."""
    starts = [0]
    for m in _BREAK.finditer(text):
        starts.append(m.end())
    if len(starts) > 1 and starts[-1] == len(text):
        starts.pop()
    ends = starts[1:] + [len(text)]
    return [(a, b) for a, b in zip(starts, ends, strict=True) if b > a]


def size_runs(lengths: np.ndarray, text_of: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) sentence of the shortest runs from and up to each sentence.

    ``lengths`` are words per sentence and ``text_of`` the number of its text, rising; runs stay within a text.
    """
    n = len(lengths)
    sums = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(n)
    first, last = np.searchsorted(text_of, text_of, "left"), np.searchsorted(text_of, text_of, "right") - 1
    ends = np.maximum(np.searchsorted(sums, sums[:-1] + min_words, "left") - 1, at + 1)
    starts = np.minimum(np.searchsorted(sums, sums[1:] - min_words, "right") - 1, at - 1)
    ahead, back, alone = ends <= last, starts >= first, (first == last) & (lengths >= min_words)
    pairs = np.unique(np.concatenate([at[ahead] * n + ends[ahead], starts[back] * n + at[back], at[alone] * n + at[alone]]))
    return pairs // max(n, 1), pairs % max(n, 1)


def fixed_runs(lengths: np.ndarray, text_of: np.ndarray, min_words: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) sentence of each run of ``span`` sentences, or of a whole shorter text, that has enough words."""
    sums = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(len(lengths))
    first, last = np.searchsorted(text_of, text_of, "left"), np.searchsorted(text_of, text_of, "right") - 1
    ends = np.where((at == first) & (first + span - 1 > last), last, at + span - 1)
    fit = ends <= last
    fit[fit] = sums[ends[fit] + 1] - sums[at[fit]] >= min_words
    return at[fit], ends[fit]


def _lanes(digests: list[bytes]) -> np.ndarray:
    """Digests of 16 bytes as two rows of numbers."""
    return np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2).T


def chosen_places(rolled: np.ndarray, text_of: np.ndarray, window: int) -> np.ndarray:
    """Places with the least hash of each ``window`` successive ones of a text (of all, if there are fewer)."""
    if not len(rolled):
        return np.zeros(0, np.int64)
    out = []
    width = min(window, len(rolled))
    within = text_of[: len(rolled) - width + 1] == text_of[width - 1 :]
    least = np.lib.stride_tricks.sliding_window_view(rolled, width).argmin(axis=1)
    out.append((least + np.arange(len(least)))[within])
    cuts = np.flatnonzero(np.diff(text_of)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(rolled)], strict=True):
        if b - a < window:
            out.append([a + int(rolled[a:b].argmin())])
    return np.unique(np.concatenate(out)).astype(np.int64)


def batch_runs(texts: list[str], min_words: int, span: int | None, word_run: int | None) -> dict[str, np.ndarray]:
    """The runs of a batch: number of the ``text``, ``at`` and ``to`` (first and last sentence, or word), hash ``h``, ``g``.

    A hash has 96 bits, as two numbers, which take less room in a shuffle than bytes.
    """
    digests, lengths, numbers, text_of, words, word_text = [], [], [], [], [], []
    for t, text in enumerate(texts):
        for k, (a, b) in enumerate(sentence_bounds(text)):
            held = text[a:b].lower().split()
            if held:
                digests.append(blake2b(" ".join(held).encode(), digest_size=16).digest())
                lengths.append(len(held))
                numbers.append(k)
                text_of.append(t)
                if word_run:
                    words += map(_word_hash.__getitem__, held)
        if word_run:
            word_text.append(len(words))
    lengths, numbers, text_of = (np.array(x, np.int64) for x in (lengths, numbers, text_of))
    first, last = fixed_runs(lengths, text_of, min_words, span) if span else size_runs(lengths, text_of, min_words)
    hashes = [span_hashes(lane, first, last + 1) for lane in _lanes(digests)]
    found = [(text_of[first], numbers[first], numbers[last], *hashes)]
    if word_run and words:
        lanes, ends = _lanes(words), np.array(word_text)
        head = np.concatenate([[0], ends[:-1]])
        of_word = np.repeat(np.arange(len(texts)), ends - head)
        at = np.arange(max(0, len(of_word) - word_run + 1))
        at = at[of_word[at] == of_word[at + word_run - 1]]
        rolled = [span_hashes(lane, at, at + word_run) for lane in lanes]
        chosen = chosen_places(rolled[0], of_word[at], WINDOW)
        where = at[chosen]
        place = where - head[of_word[where]] + _WORDS_FROM
        # Runs of words have hashes of their own, apart from those of sentences.
        found.append((of_word[where], place, place + word_run - 1, rolled[0][chosen], ~rolled[1][chosen]))
    text, at, to, h, g = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(text, kind="stable")
    return {"text": text[order], "at": at[order], "to": to[order], "h": h[order], "g": g[order] >> np.uint64(32)}


def characters(text: str, places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(start, end) in characters of runs given by their first and last sentence or word."""
    bounds = sentence_bounds(text) if any(a < _WORDS_FROM for a, _ in places) else []
    starts = [m.start() for m in _WORD.finditer(text)] + [len(text)] if any(a >= _WORDS_FROM for a, _ in places) else []
    return [
        (bounds[a][0], bounds[b][1]) if a < _WORDS_FROM else (starts[a - _WORDS_FROM], starts[b - _WORDS_FROM + 1]) for a, b in places
    ]


def without(text: str, ranges: list[tuple[int, int]]) -> tuple[str, int, int, list[int]]:
    """Text without ``ranges`` of characters: text, sentences, sentences removed as a whole, bounds removed."""
    cuts: list[int] = []
    for a, b in sorted(ranges):
        if cuts and a <= cuts[-1]:
            cuts[-1] = max(cuts[-1], b)
        else:
            cuts += [a, b]
    edges = [0, *cuts, len(text)]
    kept = "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
    bounds, removed, k = sentence_bounds(text), 0, 0
    for a, b in bounds:
        while k < len(cuts) and cuts[k + 1] < b:
            k += 2
        removed += k < len(cuts) and cuts[k] <= a
    return kept, len(bounds), removed, cuts


def repeated_runs(
    docs: DataFrame, doc_id: str, text: str, min_words: int, span: int | None = None, word_run: int | None = None
) -> DataFrame:
    """``_id, _page, ranges``: per document the runs that also stand earlier, as first and last sentences or words.

    One shuffle by hash finds the first place and the number of each run with partial aggregation; only
    hashes seen at more than one place are joined back to the places, when that shuffle's files are gone.
    """
    source = (
        docs.where(F.length(text) > 0)
        .select(F.col(doc_id).cast("long").alias("_id"), F.xxhash64(text).alias("_page"), F.col(text).alias("_text"))
    )

    def hashed(batch: pa.RecordBatch) -> Iterator[dict]:
        found = batch_runs(batch["_text"].to_pylist(), min_words, span, word_run)
        ends = np.cumsum(np.bincount(found["text"], minlength=batch.num_rows))
        offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
        kinds = {"at": np.int32, "to": np.int32, "h": np.int64, "g": np.int32}
        numbers = {n: found[n].astype(np.uint32).view(k) if n == "g" else found[n].astype(k) for n, k in kinds.items()}
        lists = {n: pa.ListArray.from_arrays(offsets, pa.array(x)) for n, x in numbers.items()}
        yield {"_id": batch["_id"], "_page": batch["_page"]} | lists

    schema = "_id long, _page long, at array<int>, to array<int>, h array<long>, g array<int>"
    listed = materialize(map_arrow(source, hashed, schema), "spans")
    each = listed.select("_id", "_page", F.explode(F.arrays_zip("at", "to", "h", "g")).alias("s")).select(
        "_id", "_page", *[F.col(f"s.{c}").alias(c) for c in ("at", "to", "h", "g")]
    )
    place = F.struct(F.col("_id"), F.col("_page"), F.col("at"))
    heads = (
        each.groupBy("h", "g")
        .agg(F.min(place).alias("head"), F.max(place).alias("tail"))
        .where("head <> tail")
        .select("h", "g", "head")
    )
    heads = materialize(heads, "span-heads")
    release(docs.sparkSession)
    later = each.join(heads, ["h", "g"]).where(~place.eqNullSafe(F.col("head")))
    marks = materialize(later.groupBy("_id", "_page").agg(F.collect_set(F.struct("at", "to")).alias("ranges")), "span-marks")
    discard(listed, heads)
    release(docs.sparkSession)
    return marks


def drop_repeated_spans(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    span: int | None = None,
    word_run: int | None = None,
) -> DataFrame:
    """``docs`` without repeated sentences in ``text``; with ``word_run`` also without repeated runs of so many words.

    Adds ``n_sentences``, ``n_removed`` and ``cuts`` (starts and ends, in characters, of what went).
    """
    marks = repeated_runs(docs, doc_id, text, min_words, span, word_run)
    keyed = docs.select(
        whole_row(docs).alias("row"),
        F.col(doc_id).cast("long").alias("id"),
        F.col(text).alias("text"),
        F.xxhash64(text).alias("page"),
    )
    joined = keyed.join(marks, keyed["id"].eqNullSafe(marks["_id"]) & (keyed["page"] == marks["_page"]), "left")
    joined = joined.select("row", "text", "ranges")

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        texts, ranges = batch["text"].to_pylist(), batch["ranges"].to_pylist()
        pairs = [[(x["at"], x["to"]) for x in r or []] for r in ranges]
        done = [without(t, characters(t, p)) if t else (t, 0, 0, []) for t, p in zip(texts, pairs, strict=True)]
        yield {
            "row": batch["row"],
            "kept": pa.array([d[0] for d in done], pa.string()),
            "n_sentences": pa.array([d[1] for d in done], pa.int64()),
            "n_removed": pa.array([d[2] for d in done], pa.int64()),
            "cuts": pa.array([d[3] for d in done], pa.list_(pa.int32())),
        }

    added = StructType.fromDDL("kept string, n_sentences long, n_removed long, cuts array<int>")
    out = map_arrow(joined, cut, StructType([joined.schema["row"], *added.fields]))
    new = {text: F.col("kept")} | {n: F.col(n) for n in added.names[1:]}
    return unpacked(out, docs.columns, "row", new)
