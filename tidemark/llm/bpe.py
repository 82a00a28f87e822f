"""BPE encoding and decoding with a given vocabulary file.

Encoding merges by a priority queue of merge ranks over a doubly linked list of symbols; an entry whose
symbols have changed since is stale and skipped. Decoding joins vocabulary strings.

The file describes a normaliser (NFC, white space to one space, lower case), a pattern whose matches are
the words, a byte alphabet and an end-of-word mark. Strings of special tokens in a text become those
tokens, as they do in the ``tokenizers`` library.

Defined results: null and empty texts have no tokens and decode to the empty string. Repeated rows each
get their own row. Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Memory, map_arrow

#: Characters of a text whose words are held at once.
PIECE = 1 << 20


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where it prints, else one from 256 up."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Codec:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        # Rank of each pair of ids; the id that each rank makes.
        self.ranks = {(self.vocab[a], self.vocab[b]): rank for rank, (a, b) in enumerate(model["merges"])}
        self.made = [self.vocab[a + b] for a, b in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        letters = byte_alphabet()
        self.inner = [self.vocab.get(c, -1) for c in letters]
        self.last = [self.vocab.get(c + self.suffix, -1) for c in letters]
        #: Ids (little-endian 32-bit integers) and decoded text of a word.
        self.known = Memory(self._word, 300_000)

    def merge(self, symbols: list[int]) -> list[int]:
        """Apply merges in order of rank, leftmost first among equals."""
        n = len(symbols)
        if n < 3:
            rank = self.ranks.get(tuple(symbols))
            return symbols if rank is None else [self.made[rank]]
        rank_of, made, ids = self.ranks.get, self.made, symbols[:]
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        # An entry is a rank and a place in one number, so that the heap compares numbers.
        shift = n.bit_length()
        places = (1 << shift) - 1
        queue = [r << shift | i for i, r in enumerate(map(rank_of, zip(symbols, symbols[1:], strict=False))) if r is not None]
        heapify(queue)
        while queue:
            entry = heappop(queue)
            i, rank = entry & places, entry >> shift
            j = after[i]
            if j < 0 or rank_of((ids[i], ids[j])) != rank:
                continue  # stale: one of its symbols went into another merge
            new = ids[i] = made[rank]
            ids[j] = -1
            k = after[i] = after[j]
            after[j] = -1
            if k >= 0:
                before[k] = i
                r = rank_of((new, ids[k]))
                if r is not None:
                    heappush(queue, r << shift | i)
            h = before[i]
            if h >= 0:
                r = rank_of((ids[h], new))
                if r is not None:
                    heappush(queue, r << shift | h)
        return [x for x in ids if x >= 0]

    def _word(self, word: str) -> tuple[bytes, str]:
        data = word.encode("utf-8")
        symbols = [*map(self.inner.__getitem__, data[:-1]), self.last[data[-1]]]
        ids = self.merge([x for x in symbols if x >= 0])
        return packed(ids), self.decode(ids)

    def parts(self, text: str) -> list[tuple[bytes, str]]:
        """Ids and decoded text of each word of a text without special tokens."""
        text = unicodedata.normalize("NFC", text)
        # Lower case letter by letter: a final sigma is a matter of context only to str.lower.
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        return [*map(self.known.__getitem__, self.words.findall(text))]

    def pieces(self, text: str) -> Iterator[list[tuple[bytes, str]]]:
        """The words of a whole text, piece by piece; strings of special tokens become those."""
        at = 0
        for m in self.specials.finditer(text):
            yield from map(self.parts, _cut(text[at : m.start()]))
            yield [(packed([self.special[m[0]]]), m[0])]
            at = m.end()
        yield from map(self.parts, _cut(text[at:]))

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text; strings of special tokens become their ids."""
        return [*array("I", b"".join([p[0] for part in self.pieces(text) for p in part]))]

    def decode(self, ids: list[int]) -> str:
        """The vocabulary strings joined by spaces, as the library does for a file without a decoder."""
        return " ".join(map(self.strings.__getitem__, ids))

    def encode_decode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers, and the decoded text."""
        ids, strings = [], []
        for part in self.pieces(text):
            ids.append(b"".join([p[0] for p in part]))
            strings.append(" ".join([p[1] for p in part if p[1]]))
        return b"".join(ids), " ".join(filter(None, strings))


def _cut(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces that end before a space, so that no word is cut."""
    at = 0
    while at < len(text):
        end = text.find(" ", at + size)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


def packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a file, loaded once per process."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` (array of int) and ``decoded`` of every whole text."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        c = codec(path)
        ids = [c.encode(t) for t in batch["text"].to_pylist()]
        yield {
            "doc_id": batch["doc_id"],
            "ids": pa.array(ids, pa.list_(pa.int32())),
            "decoded": pa.array([c.decode(i) for i in ids], pa.string()),
        }

    return map_arrow(_texts(docs, doc_id, text), run, "doc_id long, ids array<int>, decoded string")


def encoded_digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``; ids and texts stay in the tasks."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        c, n, a, b = codec(path), [], [], []
        for t in batch["text"]:
            ids, decoded = c.encode_decode(t.as_py())
            n.append(len(ids) // 4)
            a.append(hashlib.sha256(ids).hexdigest())
            b.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
        yield {
            "doc_id": batch["doc_id"],
            "n_tokens": pa.array(n, pa.int64()),
            "ids_sha256": pa.array(a, pa.string()),
            "decoded_sha256": pa.array(b, pa.string()),
        }

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_arrow(_texts(docs, doc_id, text), run, schema)


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
