"""Hard-negative mining with angular triangle filtering.

Every vector stores its length and its angles to a few reference directions. For an anchor at angles a and a
vector at angles t, the angle between them is at least max |a - t| and at most min(a + t, 2 pi - a - t), which
gives an interval for their cosine and, times the lengths, for their score. The interval is widened for
rounding. Only where it overlaps a window that is still open are scores computed, and those are exact integers.

Vectors are sorted by their nearest reference and the angle to it, so that neighbours form cells with narrow
ranges of angles: cells are passed over by one test of their ranges. What is left of a cell is scored by one matrix
product, in the smallest floats that hold every sum exactly; a bound for a single vector costs more than such
a score, so these are taken only where floats are not exact. The anchors are dealt to blocks of
at most ``BLOCK_BYTES``; each block is sent to the tasks in turn and meets the vectors where they are. A first
pass finds the positives of an anchor, a second the negatives in the windows that the positives open.

Defined results: rows take no part if their id, label or vector is null or a component is null or not finite.
Shorter vectors count as padded with zeros; a vector of length 0 has score 0 with all. Rows with an equal id
count once, with the smallest label and vector. An anchor without positives has no rows. Scores beyond 64 bits
are cut to that range. Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, dealt_blocks, map_arrow
from tidemark.session import discard, materialize

#: Positives of an anchor, negatives of a positive, and the share of its score that a negative has at least.
POSITIVES, NEGATIVES, LEAST = 5, 5, (80, 100)
#: Reference directions, numbers of the bounded sample that they are taken from, and rounds that center them.
REFERENCES, SAMPLE_NUMBERS, ROUNDS = 12, 1_000_000, 5
#: Bytes of anchors that one pass takes; vectors of a cell; anchors that are scored at once.
BLOCK_BYTES, CELL, STEP = 16 << 20, 250, 1024
#: Share of a matrix of scores above which those that windows need are first narrowed to the best of each row.
CROWDED = 0.1
#: Stored angles are off by less; scores are off by a billionth of the product of the lengths, and by 1.
ANGLE_SLACK, SCORE_SLACK = 1e-6, 1e-9
_FLOOR, _LIMIT = -(1 << 63), (1 << 63) - 1


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", factor: int = 256) -> DataFrame:
    """``id, label, v``: floor(factor * x) per component, of the rows that take part."""
    v = F.col("v")
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(embedding).cast("array<double>").alias("v")
    )
    rows = rows.dropna(subset=["id", "label", "v"]).where(~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    rows = rows.select("id", F.struct("label", F.transform(v, lambda x: F.floor(x * factor).cast("long")).alias("v")).alias("r"))
    return rows.groupBy("id").agg(F.min("r").alias("r")).select("id", "r.label", "r.v")


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Lists of integers as rows, padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(lengths) and (lengths == dim).all():
        return flat.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim), np.int64)
    out[np.arange(dim) < lengths[:, None]] = flat
    return out


def references(rows: DataFrame, dim: int) -> np.ndarray:
    """Unit directions in the middle of the sample's clusters; the sample is chosen by a hash of the id."""
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(max(1, SAMPLE_NUMBERS // dim)).select("v").toArrow()
    x = matrix(sample["v"], dim).astype(np.float64)
    lengths = np.sqrt((x**2).sum(1))
    x = x[lengths > 0] / lengths[lengths > 0, None]
    if not len(x):
        return np.eye(dim)[:1]
    far = [0]  # each next one is the farthest from those before
    nearest = x @ x[0]
    while len(far) < min(REFERENCES, len(x)) and nearest.min() < 1 - 1e-9:
        far.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, x @ x[far[-1]])
    centers = x[far]
    for _ in range(ROUNDS):
        own = (x @ centers.T).argmax(1)
        sums = np.stack([x[own == k].sum(0) for k in range(len(centers))])
        size = np.sqrt((sums**2).sum(1))
        centers = np.where(size[:, None] > 1e-9, sums / np.maximum(size, 1e-9)[:, None], centers)
    return centers


def with_angles(rows: DataFrame, refs: np.ndarray) -> DataFrame:
    """The rows with ``length``, ``angles``, and ``cell`` and ``near``: the nearest reference and the angle to it."""
    dim = refs.shape[1]

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        x = matrix(batch["v"], dim).astype(np.float64)
        lengths = np.sqrt((x**2).sum(1))
        angles = np.arccos(np.clip(x @ refs.T / np.maximum(lengths, 1e-300)[:, None], -1, 1))
        cell = angles.argmin(1)
        yield {
            "id": batch["id"], "label": batch["label"], "v": batch["v"], "length": pa.array(lengths),
            "angles": pa.array(list(angles), pa.list_(pa.float64())), "cell": pa.array(cell.astype(np.int32)),
            "near": pa.array(angles[np.arange(len(x)), cell]),
        }

    return map_arrow(rows, run, "id long, label long, v array<long>, length double, angles array<double>, cell int, near double")


def score_bounds(
    lengths: np.ndarray, angles: np.ndarray, x_lengths: tuple[np.ndarray, np.ndarray], x_angles: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) score of each anchor with each vector, or each cell of vectors, widened for rounding.

    ``x_lengths`` and ``x_angles`` are the least and greatest of a cell; of a single vector both are its own.
    """
    least = np.zeros((len(lengths), len(x_lengths[0])))
    most = np.full_like(least, np.pi)
    for k in range(angles.shape[1]):
        a, lo, hi = angles[:, k, None], x_angles[0][None, :, k], x_angles[1][None, :, k]
        np.maximum(least, np.maximum(a - hi, lo - a), out=least)
        np.minimum(most, np.minimum(a + hi, 2 * np.pi - a - lo), out=most)
    top = np.cos(np.clip(least - 2 * ANGLE_SLACK, 0, np.pi))
    low = np.cos(np.clip(most + 2 * ANGLE_SLACK, 0, np.pi))
    slack = 1 + SCORE_SLACK * lengths[:, None] * x_lengths[1]
    most = lengths[:, None] * np.where(top > 0, x_lengths[1], x_lengths[0]) * top + slack
    least = lengths[:, None] * np.where(low > 0, x_lengths[0], x_lengths[1]) * low - slack
    return least, most


def exact_floats(most: float) -> type | None:
    """The smallest floats in which sums of whole numbers are exact, if none and no part of one is beyond ``most``."""
    return np.float32 if most < 2**24 * (1 - 1e-6) else np.float64 if most < 2**53 * (1 - 1e-6) else None


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of integers, cut to 64 bits."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if most < 2**63:
        return q @ x.T
    return np.clip(q.astype(object) @ x.T.astype(object), _FLOOR, _LIMIT).astype(np.int64)


def lowered(x: np.ndarray, kind: np.dtype) -> np.ndarray:
    """The numbers in floats of a ``kind``, rounded down; other kinds are compared as they are."""
    if kind != np.float32:
        return x
    out = x.astype(kind)
    return np.where(out > x, np.nextafter(out, kind.type(-np.inf)), out)


class Best:
    """The ``k`` best (score, smaller id first) of each slot of each anchor."""

    def __init__(self, shape: tuple[int, int], k: int) -> None:
        n = shape[0] * shape[1]
        self.shape, self.k, self.count = shape, k, np.zeros(n, np.int64)
        self.score, self.id = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)
        #: A float just below the score of the k-th best: what is below it is not needed.
        self.beat = np.full(n, -np.inf)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Merge new ones into their slots; the others are not touched."""
        last = self.score[slot, -1]
        better = (self.count[slot] < self.k) | (score > last) | ((score == last) & (ids < self.id[slot, -1]))
        slot, score, ids = slot[better], score[better], ids[better]
        if not len(slot):
            return
        mine = np.unique(slot)
        held = np.arange(self.k) < self.count[mine, None]
        slot = np.r_[slot, np.repeat(mine, self.count[mine])]
        score, ids = np.r_[score, self.score[mine][held]], np.r_[ids, self.id[mine][held]]
        # ~score falls as the score rises and cannot overflow.
        order = np.lexsort((ids, ~score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        nth = np.arange(len(slot)) - np.searchsorted(slot, slot, side="left")
        kept = nth < self.k
        slot, score, ids, nth = slot[kept], score[kept], ids[kept], nth[kept]
        self.score[slot, nth], self.id[slot, nth] = score, ids
        np.maximum.at(self.count, slot, nth + 1)
        full = nth == self.k - 1
        self.beat[slot[full]] = np.nextafter(score[full].astype(np.float64), -np.inf)

    def needed(self, rows: slice | np.ndarray) -> np.ndarray:
        return self.beat.reshape(self.shape)[rows]

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slot, score, id) of all that are held."""
        held = np.arange(self.k) < self.count[:, None]
        return np.nonzero(held)[0], self.score[held], self.id[held]


class Anchors:
    """One block of anchors with their windows (score between ``low`` and ``high``), and what they have found."""

    def __init__(self, block: pa.Table, dim: int, k: int) -> None:
        self.id, self.label = block["id"].to_numpy(), block["label"].to_numpy()
        self.v, self.lengths = matrix(block["v"], dim), block["length"].to_numpy()
        self.angles = np.array(block["angles"].to_pylist()).reshape(len(self.id), -1)
        self.same = "high" not in block.column_names
        highs = [[_LIMIT]] * len(self.id) if self.same else block["high"].to_pylist()
        width = max(map(len, highs), default=1)
        # An anchor with fewer windows than others has empty ones: none is above the highest and below the lowest.
        self.open = np.array([[i < len(h) for i in range(width)] for h in highs]).reshape(len(highs), width)
        self.high = np.array([h + [_FLOOR] * (width - len(h)) for h in highs], dtype=np.int64).reshape(len(highs), width)
        self.best = Best(self.high.shape, k)
        share = LEAST[0] / LEAST[1]
        self.low = np.full(self.high.shape, -np.inf) if self.same else np.where(self.open, self.high * share - 1 - SCORE_SLACK * abs(self.high.astype(float)), np.inf)
        self._floats: dict[type, np.ndarray] = {}

    def floats(self, kind: type) -> np.ndarray:
        if kind not in self._floats:
            self._floats[kind] = self.v.astype(kind)
        return self._floats[kind]

    def overlap(self, rows: slice | np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Whether a score interval meets a window of its anchor that is still open there."""
        need = np.maximum(self.low[rows], self.best.needed(rows))
        high = self.high[rows].astype(np.float64)
        out = np.zeros(most.shape, bool)
        for i in range(need.shape[1]):
            out |= (most >= need[:, i, None]) & (least <= high[:, i, None])
        return out

    def meet(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, lengths: np.ndarray, angles: np.ndarray) -> None:
        """Score a batch of vectors where the bounds leave a chance."""
        cuts = np.arange(0, len(ids), CELL)
        cell_lengths = np.minimum.reduceat(lengths, cuts), np.maximum.reduceat(lengths, cuts)
        cell_angles = np.minimum.reduceat(angles, cuts), np.maximum.reduceat(angles, cuts)
        # No part of a sum is beyond the product of the lengths (Cauchy-Schwarz).
        kind = exact_floats(float(self.lengths.max(initial=0)) * float(lengths.max(initial=0)))
        x = v if kind is None else v.astype(kind)
        near = self.overlap(slice(None), *score_bounds(self.lengths, self.angles, cell_lengths, cell_angles))
        for c in np.flatnonzero(near.any(0)):
            cell, rows = np.arange(cuts[c], min(cuts[c] + CELL, len(ids))), np.flatnonzero(near[:, c])
            for part in (rows[at : at + STEP] for at in range(0, len(rows), STEP)):
                if kind is not None:
                    self.take(part, ids[cell], labels[cell], self.floats(kind)[part] @ x[cell].T)
                    continue
                can = self.overlap(part, *score_bounds(self.lengths[part], self.angles[part], (lengths[cell], lengths[cell]), (angles[cell], angles[cell])))
                can &= self.fitting(part, ids[cell], labels[cell])
                some, cols = np.flatnonzero(can.any(1)), cell[can.any(0)]
                if len(some):
                    self.take(part[some], ids[cols], labels[cols], products(self.v[part[some]], v[cols]))

    def fitting(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Whether a vector is another one than the anchor, of its label or, for negatives, of another."""
        return ((self.label[rows, None] == labels) == self.same) & (self.id[rows, None] != ids)

    def narrowed(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, score: np.ndarray, need: np.ndarray) -> np.ndarray:
        """What the windows of ``rows`` need, at least the k-th best of these scores that are in a window or below it."""
        fitting, need = self.fitting(rows, ids, labels), need.copy()
        for i in range(need.shape[1]):
            held = np.where(fitting & (score <= self.high[rows, i, None].astype(np.float64)), score, -np.inf)
            need[:, i] = np.maximum(need[:, i], np.partition(held, -self.best.k, axis=1)[:, -self.best.k])
        return need

    def take(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, score: np.ndarray) -> None:
        width = self.high.shape[1]
        need = np.maximum(self.low[rows], self.best.needed(rows))
        hits = np.flatnonzero(score >= lowered(need.min(1), score.dtype)[:, None])
        if len(hits) > CROWDED * score.size and score.dtype.kind == "f" and len(ids) > self.best.k:
            need = self.narrowed(rows, ids, labels, score, need)
            hits = np.flatnonzero(score >= lowered(need.min(1), score.dtype)[:, None])
        if not len(hits):
            return
        r, c = np.divmod(hits, len(ids))
        got, row = score.ravel()[hits].astype(np.int64), rows[r]
        fits = ((self.label[row] == labels[c]) == self.same) & (self.id[row] != ids[c])
        r, c, row, got = r[fits], c[fits], row[fits], got[fits]
        for i in range(width):
            high = self.high[row, i]
            fits = self.open[row, i] & (got >= need[r, i])
            if not self.same:
                fits &= (got <= high) & in_window(high, got)
            if fits.any():
                self.best.add(row[fits] * width + i, got[fits], ids[c[fits]])

    def found(self) -> pa.RecordBatch:
        slot, score, ids = self.best.all()
        rows, slots = np.divmod(slot, self.high.shape[1])
        columns = [pa.array(self.id[rows]), pa.array(slots.astype(np.int32)), pa.array(ids), pa.array(score)]
        return pa.RecordBatch.from_arrays(columns, names=["anchor_id", "slot", "vec_id", "score"])


def in_window(high: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Whether LEAST[0] * high <= LEAST[1] * score, in integers that do not overflow."""
    a, b = LEAST[0] // np.gcd(*LEAST), LEAST[1] // np.gcd(*LEAST)
    if max(abs(int(high.max(initial=0))), abs(int(high.min(initial=0))), abs(int(score.max(initial=0))), abs(int(score.min(initial=0)))) < 2**60 // b:
        return a * high <= b * score
    return a * high.astype(object) <= b * score.astype(object)


_FOUND = "anchor_id long, slot int, vec_id long, score long"


def _pass(rows: DataFrame, anchors: DataFrame, dim: int, k: int) -> DataFrame:
    """The ``k`` best of each window of each anchor: ``anchor_id, slot, rank, vec_id, score``, written."""
    dealt, blocks = dealt_blocks(anchors, 8.0 * (F.size("v") + F.size("angles") + 12 * k), ("id",), BLOCK_BYTES)
    names = [c for c in ("id", "label", "v", "length", "angles", "high") if c in anchors.columns]
    vectors = rows.select("id", "label", "v", "length", "angles")
    bound_batches(rows.sparkSession)
    parts = []
    for block in blocks:
        own = dealt.where(F.col("block") == block).select(*names).toArrow()

        def run(batches: Iterator[pa.RecordBatch], own: pa.Table = own) -> Iterator[pa.RecordBatch]:
            held = Anchors(own, dim, k)
            for b in batches:
                if b.num_rows:
                    angles = b["angles"].flatten().to_numpy().reshape(b.num_rows, -1)
                    held.meet(b["id"].to_numpy(), b["label"].to_numpy(), matrix(b["v"], dim), b["length"].to_numpy(), angles)
            yield held.found()

        # Written at once, so that the driver holds one block of anchors at a time.
        parts.append(materialize(vectors.mapInArrow(run, _FOUND), "found"))
    if not parts:
        return rows.sparkSession.createDataFrame([], _FOUND).withColumn("rank", F.lit(0))
    place = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    best = reduce(DataFrame.union, parts).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    out = materialize(best, "best")
    discard(*parts)
    return out


def hard_negatives(rows: DataFrame, anchor_step: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from what ``usable`` gives.

    Anchors are the ids that ``anchor_step`` divides; their positives the best rows of the same label; a
    positive's negatives the best rows of other labels with a score in its window.
    """
    held = materialize(rows, "vectors")
    dim = max(1, held.agg(F.max(F.size("v")).alias("d")).first()["d"] or 1)
    angled = with_angles(held, references(held, dim))
    # Ids break ties, so that equal vectors spread over ranges too.
    order = ["cell", "near", "id"]
    sorted_rows = materialize(angled.repartitionByRange(*order).sortWithinPartitions(*order), "angles")
    discard(held)
    anchors = sorted_rows.where(F.col("id") % anchor_step == 0)
    best = _pass(sorted_rows, anchors, dim, positives)
    by_rank = F.array_sort(F.collect_list(F.struct("rank", "score")))
    windows = best.groupBy(F.col("anchor_id").alias("a")).agg(F.transform(by_rank, lambda p: p["score"]).alias("high"))
    found = _pass(sorted_rows, anchors.join(windows, F.col("id") == F.col("a")).drop("a"), dim, negatives)
    discard(sorted_rows)
    mine = best.select(
        F.col("anchor_id").alias("a"), (F.col("rank") - 1).alias("s"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return found.join(mine, (F.col("anchor_id") == F.col("a")) & (F.col("slot") == F.col("s"))).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
