"""Suffix-array dedup: bytes covered by a string of ``LENGTH`` bytes that also starts earlier.

Suffixes are sorted by a distributed merge sort that knows common prefixes. Tasks sort their suffixes into
runs, front-code them (a suffix keeps only what differs from the one before), and send each range of the
order to one task, which merges the runs with a loser tree: two suffixes whose common prefixes with the last
winner differ are ordered without a look at their bytes, others are compared after the known prefix. The
merge gives the sorted suffixes and their common prefixes, from which the repeated strings are read.

Not every suffix is sorted. Of the grams (strings of ``GRAM`` bytes) in a window of ``LENGTH`` bytes the one
with the least hash is the window's anchor, so equal windows have equal anchors at the same place. Anchors
whose gram occurs once cannot repeat a window and stay out; the others send the suffix from the anchor and,
after it, the bytes before the anchor backwards, which together hold all windows of the anchor.

Equal documents are merged first: all but the smallest id are removed as a whole. Equal suffixes of a task
leave it once, so a passage in a third of all documents reaches the merge as one suffix per task.

Defined results: a null text is an empty one. A null id is smaller than all others. Rows with equal id and
text are one document, and each gets the result. Rows that share an id with different texts count as one
document in which both start at byte 0; places that are equal in both remove nothing. Bytes that a removal
cuts within a character stay bytes: results carry hashes, and texts decode with replacement. Only the named
columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, digest16, map_arrow, release
from tidemark.llm.hashing import LETTERS, mix, span_hashes
from tidemark.session import discard, materialize

#: Bytes of a repeated string, and of the gram that anchors it.
LENGTH, GRAM = 100, 32
#: Suffixes of a run at most, and of a range of the merge, about.
RUN, RANGE = 100_000, 60_000
#: Documents, and anchors of each, that the ranges' limits are taken from.
SAMPLED, SAMPLED_EACH = 1_000, 40
#: Bytes of a text whose anchors are found at once, and anchors whose suffixes are cut out at once.
SEGMENT, SLICE = 4 << 20, 20_000

_BACK = LENGTH - GRAM  # most bytes of a window before its anchor
_WIDTH = LENGTH + _BACK
_U = np.uint64
_NO_ID = -(1 << 63)


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first window, last window, hash of the gram) of a text's anchors; windows count by their start."""
    parts = [_segment(data[at : at + SEGMENT + LENGTH - 1], at) for at in range(0, max(1, len(data) - LENGTH + 1), SEGMENT)]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _segment(data: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = len(data) - LENGTH + 1
    if n < 1:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, _U))
    grams = mix(span_hashes(LETTERS[data], slice(0, len(data) - GRAM + 1), slice(GRAM, len(data) + 1)))
    # The place in the low bits makes the least value of a window unique and its leftmost.
    low = (grams & ~_U((1 << 24) - 1)) | np.arange(len(grams), dtype=_U)
    width = 1
    while 2 * width <= _BACK + 1:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = _BACK + 1 - width
    low = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
    place = (low & _U((1 << 24) - 1)).astype(np.int64)
    heads = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    tails = np.r_[heads[1:], n] - 1
    return place[heads] + at, heads + at, tails + at, grams[place[heads]]


def suffix_rows(data: np.ndarray, place: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A row per anchor: the bytes from it on, then those before it backwards; what no window needs is 0."""
    padded = np.concatenate([np.zeros(_BACK, np.uint8), data, np.zeros(LENGTH, np.uint8)])
    ahead, back = np.arange(LENGTH), np.arange(1, _BACK + 1)
    rows = np.empty((len(place), _WIDTH), np.uint8)
    rows[:, :LENGTH] = padded[place[:, None] + _BACK + ahead]
    rows[:, LENGTH:] = padded[place[:, None] + _BACK - back]
    rows[:, :LENGTH][ahead >= (last + LENGTH - place)[:, None]] = 0
    rows[:, LENGTH:][back > (place - first)[:, None]] = 0
    return rows


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """Common prefix of each sorted row with the one before, 0 for the first."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        out[1:] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return out


def front_coded(rows: np.ndarray, prefixes: np.ndarray) -> bytes:
    """The bytes of each row after its common prefix, one after another."""
    return rows[np.arange(rows.shape[1]) >= prefixes[:, None]].tobytes()


def decoded(data: bytes, prefixes: np.ndarray, width: int) -> np.ndarray:
    """The rows again: what a row does not hold comes from the nearest row before that does."""
    rows = np.zeros((len(prefixes), width), np.uint8)
    held = np.arange(width) >= prefixes[:, None]
    rows[held] = np.frombuffer(data, np.uint8)
    source = np.maximum.accumulate(np.where(held, np.arange(len(prefixes))[:, None], 0), axis=0)
    return rows[source, np.arange(width)]


def merged(runs: list[tuple[list[int], list[int]]], width: int) -> tuple[list[int], list[int], list[int]]:
    """(run, place in it, common prefix with the one before) of all suffixes in order.

    ``runs``: each its sorted suffixes as big numbers of ``width`` bytes, and their common prefixes. The tree
    holds at each inner node the loser of a match; a winner climbs from its leaf. Every suffix in the tree
    knows its common prefix with the last winner. The longer one is the smaller suffix; only equal ones are
    compared, and the number of equal leading bytes is the loser's new prefix.
    """
    k = 1
    while k < len(runs):
        k *= 2
    end = 1 << (8 * width + 1)  # a finished run
    keys = [r[0][0] if r[0] else end for r in runs] + [end] * (k - len(runs))
    known = [0 if key < end else -1 for key in keys]
    at = [0] * k

    def match(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two leaves, the loser's prefix brought up to date."""
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        x, y = keys[a], keys[b]
        if x == end:
            return a, b
        if x > y or (x == y and a > b):
            a, b = b, a
        differ = x ^ y
        known[b] = width - (differ.bit_length() + 7) // 8 if differ else width
        return a, b

    loser = [-1] * k
    level = list(range(k))
    first = k
    while len(level) > 1:
        first //= 2
        following = []
        for i in range(0, len(level), 2):
            winner, lost = match(level[i], level[i + 1])
            loser[first + i // 2] = lost
            following.append(winner)
        level = following
    winner = level[0] if level else 0
    out_run, out_at, out_known = [], [], []
    while runs and keys[winner] < end:
        out_run.append(winner)
        out_at.append(at[winner])
        out_known.append(known[winner])
        at[winner] += 1
        suffixes, prefixes = runs[winner]
        if at[winner] < len(suffixes):
            keys[winner], known[winner] = suffixes[at[winner]], prefixes[at[winner]]
        else:
            keys[winner], known[winner] = end, -1
        node = (winner + k) // 2
        while node:
            other = loser[node]
            a, b = known[winner], known[other]
            if a < b:
                loser[node], winner = winner, other
            elif a == b:
                winner, loser[node] = match(winner, other)
            node //= 2
    return out_run, out_at, out_known


def repeated(rows: np.ndarray, prefixes: np.ndarray, order: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) window of each suffix that also starts earlier, counted in bytes before the anchor; -1: none.

    Window j of a suffix is its first LENGTH - j bytes and the j bytes before it. Suffixes with equal first
    bytes stand together in the sorted order, and sorting what stands before gives classes of that, too; of
    the suffixes in one class of both the least ``order`` is the earliest.
    """
    n = len(rows)
    low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    behind = np.ascontiguousarray(rows[:, LENGTH:])
    by_back = np.argsort(behind.view(f"S{_BACK}").ravel(), kind="stable")
    back_prefix = common_prefixes(behind[by_back])
    near = np.maximum(prefixes, np.r_[prefixes[1:], 0])
    for j in range(_BACK + 1):
        live = np.flatnonzero((near >= LENGTH - j) & (least <= j) & (j <= most))
        if len(live) < 2:
            continue
        ahead = np.cumsum(prefixes < LENGTH - j)[live]
        back = np.empty(n, np.int64)
        back[by_back] = np.cumsum(back_prefix < j)
        both = ahead * (n + 1) + back[live]
        sort = np.lexsort((order[live], both))
        both, ranks = both[sort], order[live][sort]
        heads = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
        earliest = np.repeat(ranks[heads], np.diff(np.r_[heads, len(both)]))
        later = live[sort[ranks > earliest]]
        low[later] = np.where(low[later] < 0, j, low[later])
        high[later] = j
    return low, high


class _Run:
    """Suffixes of some documents, gathered in a task until a run is full."""

    def __init__(self, limits: np.ndarray) -> None:
        self.limits = limits
        self.clear()

    def clear(self) -> None:
        self.docs: list[tuple[int, bytes]] = []
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, doc: int, page: bytes, data: np.ndarray, keys: np.ndarray) -> Iterator[None]:
        """Gather the suffixes of a text; stops whenever the run is full, for the caller to send it and clear it.

        A repetitive text has an anchor at every byte, so the suffixes are cut out slice by slice.
        """
        place, first, last, grams = anchors(data)
        chosen = np.isin(grams.view(np.int64), keys)
        place, first, last = place[chosen], first[chosen], last[chosen]
        for at in range(0, len(place), min(RUN, SLICE)):
            a, b, c = (x[at : at + min(RUN, SLICE)] for x in (place, first, last))
            low = max(0, int(a[0]) - _BACK)
            near = data[low : int(a[-1]) + LENGTH]
            self.parts.append((suffix_rows(near, a - low, b - low, c - low), np.full(len(a), len(self.docs)), a, a - c, a - b))
            self.docs.append((doc, page))
            self.size += len(a)
            if self.size >= RUN:
                yield

    def sent(self) -> Iterator[tuple[int, bytes | None, int | None, bytes | None, int | None, int | None]]:
        """Rows (range, run) for the merge, and (document, start, end) of what repeats within the run itself."""
        if not self.size:
            return
        rows, doc, place, least, most = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        ids = np.array([d for d, _ in self.docs], np.int64)
        by = np.lexsort((place, ids[doc]))  # earlier ones first among equals, as the sort is stable
        by = by[np.argsort(np.ascontiguousarray(rows[by]).view(f"S{_WIDTH}").ravel(), kind="stable")]
        rows, doc, place, least, most = rows[by], doc[by], place[by], least[by], most[by]
        prefixes = common_prefixes(rows)
        heads = np.maximum.accumulate(np.where(prefixes < _WIDTH, np.arange(len(rows)), 0))
        again = (ids[doc] != ids[doc[heads]]) | (place != place[heads])
        by = np.flatnonzero(again)
        by = by[np.argsort(doc[by], kind="stable")]
        for part in np.split(by, np.flatnonzero(np.diff(doc[by])) + 1):
            if len(part):
                starts, stops = joined_spans(place[part] - most[part], place[part] - least[part] + LENGTH)
                for start, stop in zip(starts.tolist(), stops.tolist(), strict=True):
                    yield 0, None, *self.docs[doc[part[0]]], start, stop
        keep = ~again
        rows, doc, place, least, most = rows[keep], doc[keep], place[keep], least[keep], most[keep]
        first8 = np.ascontiguousarray(rows[:, :8]).view(">u8").ravel()
        ranges = np.searchsorted(self.limits, first8, side="right")
        for r in np.unique(ranges).tolist():
            a, b = np.searchsorted(ranges, r), np.searchsorted(ranges, r, side="right")
            used, number = np.unique(doc[a:b], return_inverse=True)
            prefixes = common_prefixes(rows[a:b])
            head = np.array([b - a, len(used)], "<i8").tobytes()
            names = ids[used].astype("<i8").tobytes() + b"".join(self.docs[d][1] for d in used.tolist())
            columns = [number.astype("<i4"), place[a:b].astype("<i8"), least[a:b].astype(np.uint8), most[a:b].astype(np.uint8)]
            body = b"".join(c.tobytes() for c in [*columns, prefixes.astype(np.uint8)])
            blob = head + names + body + front_coded(rows[a:b], prefixes)
            yield r, zstandard.compress(blob, 1), None, None, None, None


def _opened(blob: bytes) -> tuple[np.ndarray, ...]:
    """(rows, prefixes, ids, pages, places, least, most) of a run."""
    blob = zstandard.decompress(blob)
    n, docs = np.frombuffer(blob, "<i8", 2)
    at = 16
    parts = []
    for kind, count in (("<i8", docs), ("V16", docs), ("<i4", n), ("<i8", n), ("u1", n), ("u1", n), ("u1", n)):
        parts.append(np.frombuffer(blob, kind, count, at))
        at += parts[-1].nbytes
    ids, pages, number, place, least, most, prefixes = parts
    prefixes = prefixes.astype(np.int64)
    rows = decoded(blob[at:], prefixes, _WIDTH)
    return rows, prefixes, ids[number], pages[number], place, least.astype(np.int64), most.astype(np.int64)


def merge_range(blobs: list[bytes]) -> list[tuple[int, bytes, int, int]]:
    """(id, page, start, end) of the repeated bytes that the runs of one range show."""
    opened = [_opened(b) for b in blobs]
    numbers = []
    for rows, prefixes, *_ in opened:
        data = rows.tobytes()
        numbers.append(([int.from_bytes(data[i : i + _WIDTH]) for i in range(0, len(data), _WIDTH)], prefixes.tolist()))
    run, at, prefixes = (np.array(x, np.int64) for x in merged(numbers, _WIDTH))
    del numbers
    base = np.cumsum([0, *[len(o[0]) for o in opened]])[:-1]
    flat = base[run] + at
    rows, ids, pages, place, least, most = (np.concatenate([o[i] for o in opened])[flat] for i in (0, 2, 3, 4, 5, 6))
    by = np.lexsort((place, ids))
    step = np.r_[False, (ids[by][1:] != ids[by][:-1]) | (place[by][1:] != place[by][:-1])]
    order = np.empty(len(by), np.int64)
    order[by] = np.cumsum(step)
    low, high = repeated(rows, prefixes, order, least, most)
    hit = np.flatnonzero(low >= 0)
    spans = zip(ids[hit].tolist(), pages[hit], (place[hit] - high[hit]).tolist(), (place[hit] - low[hit] + LENGTH).tolist(), strict=True)
    return [(i, bytes(p), a, b) for i, p, a, b in spans]


_SPANS = "id long, page binary, start long, stop long"


def _span_batch(rows: list[tuple[int, bytes, int, int]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["id", "page", "start", "stop"])


def _repeated_grams(docs: DataFrame, heads: DataFrame) -> DataFrame:
    """``id, page, keys``: of the first of equal documents, the grams of anchors that occur twice or more.

    A shuffle of 32-bit hashes alone finds candidates; only those are shuffled with their documents.
    """

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        keys = [anchors(np.frombuffer(t.encode("utf-8"), np.uint8))[3].view(np.int64) for t in batch["text"].to_pylist()]
        ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        flat = np.concatenate([np.zeros(0, np.int64), *keys])
        yield {"id": batch["id"], "page": batch["page"], "keys": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))}

    all_keys = map_arrow(docs.where(F.octet_length("text") >= LENGTH), run, "id long, page binary, keys array<bigint>")
    first = materialize(all_keys.join(heads, ["id", "page"], "left_semi"), "anchors")
    each = first.select("id", "page", F.explode("keys").alias("key")).withColumn("short", F.shiftright("key", 32).cast("int"))
    twice = each.groupBy("short").agg(F.count("*").alias("c")).where("c > 1").select("short")
    maybe = materialize(each.join(twice.hint("shuffle_hash"), "short").drop("short"), "grams")
    exact = maybe.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    marks = maybe.join(exact, "key").groupBy("id", "page").agg(F.collect_set("key").alias("keys"))
    marks = materialize(marks, "marks")
    discard(first, maybe)
    return marks


def _limits(held: DataFrame, ranges: int) -> np.ndarray:
    """Limits between ranges of the first 8 bytes, from a bounded sample of anchors."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        out = []
        for text, keys in zip(batch["text"].to_pylist(), batch["keys"].to_pylist(), strict=True):
            data = np.frombuffer(text.encode("utf-8"), np.uint8)
            place, first, last, grams = anchors(data)
            chosen = np.flatnonzero(np.isin(grams.view(np.int64), keys))
            chosen = chosen[:: max(1, len(chosen) // SAMPLED_EACH)]
            rows = suffix_rows(data, place[chosen], first[chosen], last[chosen])
            out += [r.tobytes() for r in rows[:, :8]]
        yield {"first": pa.array(out, pa.binary())}

    sample = held.orderBy(F.xxhash64("page"), "id").limit(SAMPLED).select("text", "keys")
    found = np.sort(np.array([int.from_bytes(x) for x in map_arrow(sample, run, "first binary").toArrow()["first"].to_pylist()], _U))
    if not len(found):
        return np.zeros(0, _U)
    return np.unique(found[[len(found) * i // ranges for i in range(1, ranges)]])


def repeated_spans(held: DataFrame, limits: np.ndarray) -> DataFrame:
    """``id, page, start, stop`` of repeated bytes, from documents with the grams to look at (text, keys)."""
    bound_batches(held.sparkSession)
    columns = ("range", "run", "id", "page", "start", "stop")
    kinds = (pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64())

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=columns)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _Run(limits)
        for batch in batches:
            for doc, page, text, keys in zip(*[batch[c] for c in ("id", "page", "text", "keys")], strict=True):
                data = np.frombuffer(text.as_py().encode("utf-8"), np.uint8)
                for _ in run.add(doc.as_py(), page.as_py(), data, keys.values.to_numpy()):
                    yield as_batch(list(run.sent()))
                    run.clear()
        yield as_batch(list(run.sent()))

    runs = held.mapInArrow(sort, "range int, run binary, id long, page binary, start long, stop long")
    # What repeats within a run is known already; it is dealt out by document and passes the merge.
    dealt = runs.withColumn("range", F.when(F.col("run").isNull(), F.pmod(F.xxhash64("page"), F.lit(len(limits) + 1)).cast("int")).otherwise(F.col("range")))
    ordered = dealt.repartition(len(limits) + 1, "range").sortWithinPartitions("range")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, blobs = None, []
        for batch in batches:
            known = batch.filter(pa.compute.is_null(batch["run"])).select(["id", "page", "start", "stop"])
            if known.num_rows:
                yield known
            for r, blob in zip(batch["range"].to_pylist(), batch["run"].to_pylist(), strict=True):
                if r != at and blobs:
                    yield _span_batch(merge_range(blobs))
                    blobs = []
                at = r
                if blob is not None:
                    blobs.append(blob)
        if blobs:
            yield _span_batch(merge_range(blobs))

    return ordered.mapInArrow(merge, _SPANS)


def joined_spans(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the bytes that the spans cover."""
    by = np.argsort(starts, kind="stable")
    starts, reach = starts[by], np.maximum.accumulate(stops[by])
    heads = np.flatnonzero(np.r_[True, starts[1:] > reach[:-1]])
    return starts[heads], np.r_[reach[heads[1:] - 1], reach[-1:]]


def removed_bytes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` (starts and ends, in bytes) of every row."""
    spark = docs.sparkSession
    source = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("page", digest16(F.col("text")))
    rows = source.select("doc_id", "id", "page", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    rows = materialize(rows, "rows")
    heads = rows.groupBy("page").agg(F.min("id").alias("id"))
    marks = _repeated_grams(source.select("id", "page", "text"), heads)
    release(spark)
    texts = source.select("id", "page", "text").join(marks, ["id", "page"])
    held = materialize(texts.dropDuplicates(["id", "page"]), "held")
    release(spark)
    total = held.agg(F.sum(F.size("keys").cast("long"))).first()[0] or 0
    limits = _limits(held, max(1, -(-total // RANGE)))
    # Documents with the same least gram are often near copies: side by side, more of their suffixes are equal
    # within a run. A range splits those that very many share.
    dealt = held.withColumn("least", F.array_min("keys")).repartitionByRange(max(1, -(-total // RUN)), "least", "id")
    spans = repeated_spans(dealt.drop("least"), limits)
    per_doc = materialize(
        spans.groupBy("id", "page").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops")), "cuts"
    )
    release(spark)

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        out: list[list] = [[], [], [], []]
        for t, starts, stops in zip(batch["text"], batch["starts"], batch["stops"], strict=True):
            data = t.as_py().encode("utf-8")
            a, b = joined_spans(starts.values.to_numpy(), stops.values.to_numpy())
            digest, at = hashlib.sha256(), 0
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                digest.update(data[at:x])
                at = y
            digest.update(data[at:])
            out[0].append(int((b - a).sum()))
            out[1].append(len(a))
            out[2].append(digest.hexdigest())
            out[3].append(np.stack([a, b], 1).ravel().tolist())
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
        found = {n: pa.array(v, k) for n, v, k in zip(("removed", "n", "kept", "cuts"), out, kinds, strict=True)}
        yield {"k_id": batch["id"], "k_page": batch["page"]} | found

    joined = held.select("id", "page", "text").join(per_doc, ["id", "page"])
    done = map_arrow(joined, cut, "k_id long, k_page binary, removed long, n long, kept string, cuts array<bigint>")
    firsts = heads.select(F.col("page").alias("h_page"), F.col("id").alias("h_id"))
    out = rows.join(firsts, F.col("page") == F.col("h_page")).join(
        done, (F.col("id") == F.col("k_id")) & (F.col("page") == F.col("k_page")), "left"
    )
    copy = (F.col("id") > F.col("h_id")) & (F.col("n_bytes") >= LENGTH)
    whole = F.array(F.lit(0).cast("long"), F.col("n_bytes"))
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.coalesce("n", F.lit(0).cast("long"))).alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
        F.when(copy, whole).otherwise(F.coalesce("cuts", F.array().cast("array<bigint>"))).alias("spans"),
    )
