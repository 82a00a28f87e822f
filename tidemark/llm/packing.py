"""Best-fit packing by minimum bin slack.

Documents become token pieces of at most ``capacity``; pieces fill sequences. For each bin, dynamic
programming on a bitset of reachable sums over the lengths still available finds the fullest feasible
combination that holds the longest piece left, and it is removed. Only lengths matter, so the search
works on a histogram of ``capacity`` numbers whatever the corpus size: a combination is used as often as
the histogram allows. Each piece then finds its place from its rank among the pieces of its length.

Defined results: null and empty texts are the end token alone. Rows with equal ids or texts are separate
documents, each packed. A null id is an id like others. Only the named columns are read.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.bpe import byte_alphabet
from tidemark.llm.common import map_arrow
from tidemark.session import materialize

#: Tokens in a sequence, and the id that ends each document.
CAPACITY, END_ID = 1024, 2
#: Pieces that one window task ranks, about.
RANKED_TOGETHER = 50_000
#: Fixed value: the pattern of byte-level files, as their library splits text before merging.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: Characters of white space in a row beyond which a text goes to the library itself.
_LONG_SPACE = 50_000
_SPACE = re.compile(r"\s+")


class PieceTokenizer:
    """Ids of whole texts as the ``tokenizers`` library gives them for a byte-level file.

    The file's vocabulary and merges are handed to ``tiktoken``, which merges by rank the same way in a
    fifth of the time; the tests hold both against each other. Its pattern steps back over white space and gives up on
    very long runs of it, so texts with such a run are left to the library.
    """

    def __init__(self, path: str) -> None:
        self.path, self._library = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"] or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("a byte-level file without normaliser and prefix space is needed")
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        ranks = {bytes(map(byte_of.__getitem__, s)): i for s, i in spec["model"]["vocab"].items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.encoding = tiktoken.Encoding("pieces", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; strings of special tokens become those tokens."""
        if len(text) > _LONG_SPACE and any(m.end() - m.start() > _LONG_SPACE for m in _SPACE.finditer(text)):
            self._library = self._library or Tokenizer.from_file(self.path)
            return array("I", self._library.encode(text, add_special_tokens=False).ids).tobytes()
        return self.encoding.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()


_tokenizers: dict[str, PieceTokenizer] = {}


def tokenizer(path: str) -> PieceTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = PieceTokenizer(path)
    return _tokenizers[path]


def pieces(ids: bytes, capacity: int) -> list[tuple[int, bytes]]:
    """(start, ids) of a document's pieces: all full but the first, which takes what is left over."""
    n = len(ids) // 4
    first = n % capacity or capacity
    cuts = [0, *range(first, n, capacity), n] if n > capacity else [0, n]
    return [(a, ids[4 * a : 4 * b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def tokenized_pieces(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, the ``ids`` themselves, per piece."""
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    end = array("I", [end_id]).tobytes()

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        coder = tokenizer(path)
        for at in range(0, batch.num_rows, 250):
            part, rows = batch.slice(at, 250), []
            for doc, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                cut = pieces(coder.encode(text) + end, capacity)
                rows += [(doc, i, start, x) for i, (start, x) in enumerate(cut)]
            yield {
                "doc_id": pa.array([r[0] for r in rows], pa.int64()),
                "piece": pa.array([r[1] for r in rows], pa.int32()),
                "start": pa.array([r[2] for r in rows], pa.int64()),
                "length": pa.array([len(r[3]) // 4 for r in rows], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(r[3]) for r in rows], pa.int64()),
            } | ({"ids": pa.array([r[3] for r in rows], pa.binary())} if with_ids else {})

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return map_arrow(source, run, schema)


def fullest(available: list[tuple[int, int]], room: int) -> dict[int, int]:
    """Number of pieces of each length whose sum fills ``room`` best.

    ``available``: (length, count), longest first. Bit s of ``reach`` says that s can be the sum of pieces
    taken so far; a count enters in powers of two, which give every number up to it.
    """
    reach, mask, layers = 1, (1 << (room + 1)) - 1, []
    for length, count in available:
        if length > room:
            continue
        layers.append((length, reach))
        left, step = min(count, room // length), 1
        while left:
            take = min(step, left)
            reach |= (reach << (take * length)) & mask
            left, step = left - take, 2 * step
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, before in reversed(layers):
        n = 0
        while not before >> total & 1:
            total, n = total - length, n + 1
        if n:
            used[length] = n
    return used


def patterns(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, number of pieces of each length) until the histogram is used up."""
    left, out = {k: v for k, v in histogram.items() if v > 0}, []
    while left:
        longest = max(left)
        rest = sorted(((k, v - (k == longest)) for k, v in left.items() if v > (k == longest)), reverse=True)
        used = fullest(rest, capacity - longest)
        used[longest] = used.get(longest, 0) + 1
        times = min(left[k] // n for k, n in used.items())
        out.append((times, used))
        for k, n in used.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return out


def placement(found: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, pieces a bin, first sequence, first offset) for the pieces' ranks."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for times, used in found:
        offset = 0
        for length, n in used.items():
            at = taken.get(length, 0)
            rows.append((length, at, at + n * times, n, sequence, offset))
            taken[length] = at + n * times
            offset += n * length
        sequence += times
    return rows


def pack(items: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``; ``items`` must be a written table, as it is read twice.

    Pieces of one length are ranked in ``bucket``s of bounded size; the buckets' counts give each one's
    first rank. The plan has at most a few rows for each pair of a length and a combination.
    """
    spark = items.sparkSession
    counts = items.groupBy(length).count().collect()  # at most ``capacity`` rows
    histogram = {r[0]: r["count"] for r in counts}
    if any(not 0 < k <= capacity for k in histogram):
        raise ValueError("every length must be from 1 to the capacity")
    n_buckets = max(16, -(-sum(histogram.values()) // RANKED_TOGETHER))
    plan = spark.createDataFrame(
        placement(patterns(histogram, capacity)),
        "p_length long, p_from long, p_to long, p_each long, p_sequence long, p_offset long",
    )
    names = items.columns
    dealt = items.select("*", F.pmod(F.xxhash64(*names), F.lit(n_buckets)).alias("_bucket"))
    heads = dealt.groupBy(length, "_bucket").agg(F.count("*").alias("_n"))
    running = Window.partitionBy(length).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select(
        F.col(length).alias("_h_length"), F.col("_bucket").alias("_h_bucket"), F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_head")
    )
    inside = Window.partitionBy(length, "_bucket").orderBy(*_orderable(items))
    ranked = dealt.withColumn("_row", F.row_number().over(inside) - 1).join(
        heads, (F.col(length) == F.col("_h_length")) & (F.col("_bucket") == F.col("_h_bucket"))
    )
    rank = F.col("_head") + F.col("_row")
    placed = ranked.withColumn("_rank", rank).join(
        F.broadcast(plan),
        (F.col(length) == F.col("p_length")) & (F.col("_rank") >= F.col("p_from")) & (F.col("_rank") < F.col("p_to")),
    )
    nth = F.col("_rank") - F.col("p_from")
    sequence = F.col("p_sequence") + F.floor(nth / F.col("p_each")).cast("long")
    return placed.select(
        *names,
        sequence.alias("sequence_id"),
        (F.col("p_offset") + F.pmod(nth, F.col("p_each")) * F.col(length)).cast("long").alias("offset"),
    )


def _orderable(items: DataFrame) -> list[Column]:
    return [F.col(c) for c in items.columns if c != "ids"]


def pack_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Tokenise ``docs`` once and place every piece: the columns of ``tokenized_pieces`` and ``pack``."""
    return pack(materialize(tokenized_pieces(docs, path, capacity, end_id, with_ids=with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of the finished sequences, from packed pieces with ids; a group has one sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p["ids"])).alias("ids")
    )
