"""Benchmark decontamination by Wu-Manber search for many word patterns at once.

A pattern is a window of ``width`` consecutive words of an item; an item with fewer words is one shorter
pattern. Patterns of one length m share a search: a shift table holds for every block of two words how far
the search may advance (m - 1 where no pattern holds the block), a block with shift 0 selects the patterns that
end with it, a prefix block the few among them that can begin there, and these are compared word by word.

Items are cut into segments of bounded size and dealt to blocks of at most ``BLOCK_BYTES`` (or one segment).
Every block is sent to the tasks in turn and meets all documents where they are: no document is shuffled, and the
number of blocks follows the items alone.

Defined results: null and empty texts have no words and are not hit. Items with a null id or without words
take no part; items with equal ids count once. A word is a run of digits, a-z (A-Z are lowered) and characters
beyond ASCII, whatever its length; very long texts are searched piece by piece, windows across pieces included.
Repeated documents each get their own row. Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import dealt_blocks, map_arrow
from tidemark.llm.wordlists import kept_bytes, word_lists
from tidemark.session import discard, materialize

#: Words of a window, and words of a block of the shift table.
WIDTH, BLOCK_WORDS = 10, 2
#: Bytes of item words that one pass over the documents takes, and of one segment of an item.
BLOCK_BYTES, SEGMENT_BYTES = 2 << 20, 64 << 10
WORD_BYTES = kept_bytes("0123456789abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0x80, 0x100))))

Words = list[bytes]
Spans = list[tuple[int, int]]


def segments(words: Iterator[Words], width: int, size: int = SEGMENT_BYTES) -> Iterator[Words]:
    """Overlapping runs of an item's words that together hold every window once."""
    held: Words = []
    for more in words:
        held += more
        while len(held) > width and sum(map(len, held)) > size:
            n, total = 0, 0
            while n < width or total <= size and n < len(held):
                total += len(held[n])
                n += 1
            yield held[:n]
            held = held[n - width + 1 :]
    if held:
        yield held


class Search:
    """Wu-Manber search for patterns of one length."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], set[str]]) -> None:
        self.length, self.block = length, min(BLOCK_WORDS, length)
        self.far = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.ending: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list]] = defaultdict(lambda: defaultdict(list))
        b = self.block
        for pattern, items in patterns.items():
            for end in range(b, length + 1):
                block, left = pattern[end - b : end], length - end
                if left < self.shift.get(block, self.far):
                    self.shift[block] = left
            self.ending[pattern[-b:]][pattern[:b]].append((list(pattern), tuple(items)))

    def find(self, words: Words) -> Iterator[tuple[int, tuple[str, ...]]]:
        """Start and items of every occurrence, by rising start."""
        b, m, far, shift = self.block, self.length, self.far, self.shift.get
        end, n = m, len(words)
        while end <= n:
            block = tuple(words[end - b : end])
            step = shift(block, far)
            if step:
                end += step
                continue
            start = end - m
            for pattern, items in self.ending[block].get(tuple(words[start : start + b]), ()):
                if words[start:end] == pattern:
                    yield start, items
            end += 1


class Patterns:
    """All patterns of one block of items, a search for each length."""

    def __init__(self, rows: list[tuple[str, Words]], width: int) -> None:
        self.width = width
        known: dict[bytes, bytes] = {}
        by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, words in rows:
            words = [known.setdefault(w, w) for w in words]
            m = min(width, len(words))
            for i in range(len(words) - m + 1):
                by_length[m][tuple(words[i : i + m])].add(item)
        self.searches = [Search(m, by_length[m]) for m in sorted(by_length)]

    def hits(self, pieces: Iterator[Words]) -> tuple[int, Spans, set[str]]:
        """Number of words, spans of hit words (sorted and apart), items found."""
        total, held, spans, found = 0, [], [], set()
        for piece in pieces:
            words, first = held + piece, total - len(held)
            for search in self.searches:
                for start, items in search.find(words):
                    found.update(items)
                    a, z = first + start, first + start + search.length
                    if spans and spans[-1][0] <= a <= spans[-1][1]:
                        spans[-1] = (spans[-1][0], max(z, spans[-1][1]))
                    else:
                        spans.append((a, z))
            total += len(piece)
            held = words[-(self.width - 1) :] if self.width > 1 else []
        return total, joined(spans), found


def joined(spans: Spans) -> Spans:
    """Spans sorted, those that touch or overlap made one."""
    out: Spans = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def item_segments(items: DataFrame, width: int, item_id: str, text: str) -> DataFrame:
    """``item, words`` (space-joined bytes): the segments of all items that have words."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        ids, texts = batch["item"].to_pylist(), batch["text"]
        out = [(i, b" ".join(s)) for i, t in zip(ids, texts, strict=True) for s in segments(word_lists(t.as_py(), WORD_BYTES), width)]
        yield {"item": pa.array([i for i, _ in out], pa.string()), "words": pa.array([w for _, w in out], pa.binary())}

    rows = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("binary").alias("text")).dropna()
    return map_arrow(rows, run, "item string, words binary").distinct()


_built: dict[str, Patterns] = {}


def _patterns(rows: list[tuple[str, bytes]], width: int) -> Patterns:
    """The patterns of a block, built once per process; the block before it is dropped."""
    key = hashlib.sha256(repr((width, sorted(rows))).encode()).hexdigest()
    if key not in _built:
        _built.clear()
        _built[key] = Patterns([(i, w.split()) for i, w in rows], width)
    return _built[key]


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
_FOUND = "doc_id long, doc_key binary, n_words long, spans array<struct<first:long,last:long>>, items array<string>"


def _search(docs: DataFrame, rows: list[tuple[str, bytes]], width: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        patterns, keys, n, spans, found = _patterns(rows, width), [], [], [], []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
            data = text.as_py() or b""
            keys.append(hashlib.blake2b(b"%a:%b" % (doc_id, data), digest_size=16).digest())
            total, hit, items = patterns.hits(word_lists(data, WORD_BYTES))
            n.append(total)
            spans.append([{"first": a, "last": z - 1} for a, z in hit])
            found.append(sorted(items))
        yield {
            "doc_id": batch["doc_id"],
            "doc_key": pa.array(keys, pa.binary()),
            "n_words": pa.array(n, pa.int64()),
            "spans": pa.array(spans, _SPANS),
            "items": pa.array(found, pa.list_(pa.string())),
        }

    return map_arrow(docs, run, _FOUND)


def benchmark_hits(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, n_words, spans, items`` of every document.

    ``spans``: first and last number (from 0) of the words inside an occurrence of a window, as separate runs in
    order. ``items``: ids of the items that have a window in the text, as sorted strings.
    """
    held = materialize(item_segments(items, width, item_id, item_text), "benchmark")
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    dealt, blocks = dealt_blocks(held, F.length("words"), ("item", "words"), block_bytes)
    found = []
    for block in blocks or [0]:
        part = dealt.where(F.col("block") == block).select("item", "words").toArrow()
        rows = list(zip(part["item"].to_pylist(), part["words"].to_pylist(), strict=True))
        one = _search(texts, rows, width)
        # With several blocks the driver holds the items of one at a time.
        found.append(materialize(one, "hits") if len(blocks) > 1 else one)
    discard(held)
    first = found[0]
    if len(blocks) <= 1:
        return first.drop("doc_key")
    rest = reduce(DataFrame.union, found[1:])
    more = rest.groupBy(F.col("doc_key").alias("k")).agg(
        F.flatten(F.collect_set("spans")).alias("more_spans"), F.flatten(F.collect_set("items")).alias("more_items")
    )
    return _merged(first.join(more, F.col("doc_key") == F.col("k"), "left"))


def _merged(both: DataFrame) -> DataFrame:
    """The spans of all blocks joined, the items sorted."""
    rows = both.select(
        "doc_id",
        "n_words",
        F.concat("spans", F.coalesce("more_spans", F.array())).alias("spans"),
        F.array_sort(F.array_distinct(F.concat("items", F.coalesce("more_items", F.array())))).alias("items"),
    )

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        spans = [[{"first": a, "last": z - 1} for a, z in joined([(x["first"], x["last"] + 1) for x in s])] for s in batch["spans"].to_pylist()]
        yield {n: batch[n] for n in ("doc_id", "n_words", "items")} | {"spans": pa.array(spans, _SPANS)}

    return map_arrow(rows, run, rows.schema)


def contamination(hits: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` from what ``benchmark_hits`` gives."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
