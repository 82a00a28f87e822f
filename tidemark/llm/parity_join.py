"""N-gram Jaccard join by parity sketches.

A document is its set of word shingles. In a bit sketch each shingle flips one bit, so two sketches differ
in at most as many bits as the sets differ in shingles. The sketch is wide and sparse, cut into blocks, and
a block is held as the XOR of a hash per flipped bit. For sets of sizes a and b that are similar enough the
symmetric difference is at most D, fixed per band of sizes; of D + 1 + e blocks at least 1 + e agree. So a
document can only be linked through its blocks that another one shares, needs 1 + e of those, and may leave
out the e most frequent (every document leaves out by the same order, so one block in common remains).

Equal sets are one class from the start. In star rounds each document is verified against one member of one of its
buckets of equal blocks, so a round has one pair a document; what this joins needs no further check. Then most
documents have a pivot, a document that they are linked to at a known distance. A bucket that still holds several
components is first compared by its pivots, as Jaccard distances obey the triangle inequality: members of two pivots can
be linked only if these are about as near as well. Only the members of pivots that are go on to the last step. In both
steps what is compared meets again only if the parities that it flips against one center of its bucket share enough
(``prefixes``); those pairs are verified. So every link between components is found, but a group of near copies
costs about one check per member and not one per pair.

Defined results: null and empty texts and texts of white space have no shingles and no links. Shingles are
64-bit hashes. Rows that share an id are one document to the join: what one links to, all do. Rows with a
null id have no links and no component. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, map_arrow, release
from tidemark.llm.components import components
from tidemark.llm.hashing import BASE, LETTERS, mix, span_hashes
from tidemark.session import discard, materialize

#: Rounds that verify each document against a member of one of its buckets.
STAR_ROUNDS = 2
#: Members of a bucket whose pairs are taken as they are.
FEW = 8
#: Pairs that are verified against one copy of a set, about.
PAIRS_TOGETHER = 200

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = LETTERS.copy()
_LOWER[0x41:0x5B] = LETTERS[0x61:0x7B]


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words, with A-Z in lower case.

    Word hashes are differences of one running sum over the text's bytes.
    """
    data = np.frombuffer((text or "").encode("utf-8"), np.uint8)
    if not len(data):
        return np.zeros(0, _U)
    inside = np.empty(len(data) + 2, np.int8)
    inside[0] = inside[-1] = 0
    np.logical_not(_SPACE[data], out=inside[1:-1], casting="unsafe")
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.zeros(0, _U)
    words = mix(span_hashes(_LOWER[data], starts, ends) + (ends - starts).astype(_U))
    width = min(width, len(words))
    n = len(words) - width + 1
    out = words[:n] + _U(width)
    for i in range(1, width):
        out = mix(out * BASE + words[i : n + i])
    return np.unique(out)


class Bands:
    """Bands of set sizes for links with ``den`` * intersection >= ``num`` * union."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den, self.edges = num, den, [1]

    def _edge(self, i: int) -> int:
        while len(self.edges) <= i:
            low = self.edges[-1]
            self.edges.append(max(low + 1, -(-low * self.den * self.den // (self.num * self.num))))
        return self.edges[i]

    def of(self, size: int) -> list[tuple[int, int, int]]:
        """(band, D, e) of the bands in which a set of this size can have a link.

        Its own band, and those below whose largest set can still be similar to it.
        """
        own = 0
        while self._edge(own + 1) <= size:
            own += 1
        out = []
        for band in range(own, -1, -1):
            largest = self._edge(band + 1) - 1
            if largest * self.den < size * self.num:
                break
            most = largest * (self.den - self.num) // self.num
            if most:
                out.append((band, most, -(-most // 6)))
        return out


def sketch(hashes: np.ndarray, band: int, most: int, spare: int) -> tuple[int, np.ndarray]:
    """(blocks that may be left out, keys of the blocks) of a set in one band."""
    n_blocks = most + 1 + spare
    block = (hashes >> _U(11)) % _U(n_blocks)
    order = np.argsort(block, kind="stable")
    block, bits = block[order], mix(hashes[order] ^ _U(0xA0761D6478BD642F))
    heads = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    values, block = np.bitwise_xor.reduceat(bits, heads), block[heads]
    empty = n_blocks - len(block)
    if empty > spare:  # empty blocks could be all that agree: they are keys, too
        rest = np.setdiff1d(np.arange(n_blocks, dtype=_U), block, assume_unique=True)
        values, block = np.r_[values, np.zeros(len(rest), _U)], np.r_[block, rest]
    # The last two bits tell the bands of one document apart, which are neighbours.
    keys = mix(values ^ mix(_U(band << 32) + block)) & ~_U(3) | _U(band & 3)
    return max(0, spare - empty), keys.view(np.int64)


def _sketches(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """``id, n, digest, sketches`` per row; the digest stands for the whole set."""
    schema = (
        "id long, n long, digest binary, sketches array<struct<band: int, spare: int, keys: array<bigint>>>"
    )
    kind = pa.list_(pa.struct([("band", pa.int32()), ("spare", pa.int32()), ("keys", pa.list_(pa.int64()))]))

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        bands, sizes, digests, all_parts = Bands(num, den), [], [], []
        for text in batch["text"].to_pylist():
            hashes = shingles(text, width)
            sizes.append(len(hashes))
            digests.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
            parts = []
            for band, most, spare in bands.of(len(hashes)) if len(hashes) else ():
                may, keys = sketch(hashes, band, most, spare)
                parts.append((band, may, keys))
            all_parts.append(parts)
        flat = [p for parts in all_parts for p in parts]
        ends = np.cumsum([0, *[len(p[2]) for p in flat]]).astype(np.int32)
        keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *[p[2] for p in flat]])))
        struct = pa.StructArray.from_arrays(
            [pa.array([p[0] for p in flat], pa.int32()), pa.array([p[1] for p in flat], pa.int32()), keys],
            fields=list(kind.value_type),
        )
        outer = np.cumsum([0, *map(len, all_parts)]).astype(np.int32)
        yield {
            "id": batch["id"],
            "n": pa.array(sizes, pa.int64()),
            "digest": pa.array(digests, pa.binary()),
            "sketches": pa.ListArray.from_arrays(pa.array(outer), struct),
        }

    return map_arrow(docs, run, schema)


def _shared_blocks(first: DataFrame) -> DataFrame:
    """``key, id, n``: blocks through which a document can be linked, each held by two at least.

    A shuffle of 32-bit keys alone finds which occur twice; only those are shuffled with their documents.
    """
    each = first.select("id", F.explode(F.flatten(F.transform("sketches", lambda s: s["keys"]))).alias("key"))
    short = F.shiftright("key", 32).cast("int")
    twice = each.select(short.alias("short")).groupBy("short").agg(F.count("*").alias("c")).where("c > 1").select("short")
    # The short key is worked out on either side of the exchange and not sent beside the key.
    maybe = materialize(each.join(twice.hint("shuffle_hash"), short == F.col("short")).drop("short"), "blocks")
    release(first.sparkSession)
    counts = maybe.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    about = first.select("id", "n", F.explode("sketches").alias("s")).select(
        F.col("id").alias("about"), "n", F.expr("s.band & 3").alias("band"), F.col("s.spare").alias("spare")
    )
    shared = maybe.join(counts, "key").join(about, F.expr("id = about and key & 3 = band"))
    mine = Window.partitionBy("id", "n", "band")
    ranked = shared.withColumns(
        {"held": F.count("*").over(mine), "nth": F.row_number().over(mine.orderBy(F.desc("c"), "key"))}
    )
    kept = materialize(ranked.where("held > spare and nth > spare").select("key", "id", "n").distinct(), "kept")
    # What the only other document left out is shared no more.
    both = kept.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    out = materialize(kept.join(both, "key"), "shared")
    discard(maybe, kept)
    release(first.sparkSession)
    return out


def _met(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, part, b, hashes``: a copy of a's set (null b) before the sets of some b of its ``pairs`` (a, b)."""
    bound_batches(pairs.sparkSession)
    load = pairs.groupBy(F.col("a").alias("la")).agg(F.ceil(F.count("*") / PAIRS_TOGETHER).cast("int").alias("parts"))
    dealt = pairs.join(load, F.col("a") == F.col("la")).withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    heads = load.select(F.col("la").alias("a"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    heads = heads.select("a", "part", F.lit(None).cast("long").alias("b"), F.col("a").alias("of"))
    needed = heads.union(dealt.select("a", "part", "b", F.col("b").alias("of")))
    streams = needed.join(sets, F.col("of") == F.col("id")).select("a", "part", "b", "hashes")
    return streams.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, np.ndarray, list[np.ndarray]]]]:
    """Per batch of ``_met``: (a, b, b's set, the sets of a)."""
    place, held = None, []
    for batch in batches:
        out = []
        for a, part, b, raw in zip(*[batch[n].to_pylist() for n in ("a", "part", "b", "hashes")], strict=True):
            hashes = np.frombuffer(raw, _U)
            if (a, part) != place:
                place, held = (a, part), []
            if b is None:
                held.append(hashes)
            else:
                out.append((a, b, hashes, held))
        yield out


def _verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The rows of ``pairs`` (a, b) that link, with their distance ``apart`` (the least, if an id has several sets).

    Each b meets a copy of a's set, shared by a bounded number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for met in _beside(batches):
            linked = []
            for a, b, hashes, held in met:
                for other in held:
                    both = len(np.intersect1d(hashes, other, assume_unique=True))
                    union = len(hashes) + len(other) - both
                    if den * both >= num * union:
                        linked.append((a, b, 1.0 - both / union))
            kinds = [("a", pa.int64()), ("b", pa.int64()), ("apart", pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in linked], t) for i, (_, t) in enumerate(kinds)], names=[n for n, _ in kinds])

    return _met(pairs, sets).mapInArrow(run, "a long, b long, apart double").groupBy("a", "b").agg(F.min("apart").alias("apart"))


def _pivots(edges: DataFrame, sets: DataFrame, reach: float) -> DataFrame:
    """``node, pivot, apart``: documents linked to a hub at a distance of ``reach`` at most.

    A hub has more links than each document that it is linked to (ties: the smaller id). Ids that stand for several sets are left
    out, as their least distances obey no triangle inequality.
    """
    several = sets.groupBy(F.col("id").alias("s")).agg(F.count("*").alias("c")).where("c > 1").select("s")
    plain = edges.where(F.col("apart") <= reach).join(several, F.col("a") == F.col("s"), "left_anti").join(several, F.col("b") == F.col("s"), "left_anti")
    near = materialize(plain.union(plain.select("b", "a", "apart")).toDF("x", "y", "apart"), "near")
    degrees = near.groupBy(F.col("x").alias("node")).agg(F.count("*").alias("links"))
    rank = F.struct(F.col("links"), (-F.col("y")).alias("m"), F.col("y"), F.col("apart"))
    best = near.join(degrees, F.col("y") == F.col("node")).groupBy("x").agg(F.max(rank).alias("best"))
    best = best.join(degrees, F.col("x") == F.col("node")).select(
        "x", "best", (F.struct("best.links", "best.m") > F.struct(F.col("links"), (-F.col("x")).alias("m"))).alias("led")
    )
    best = materialize(best, "best")
    hubs = best.where("not led").select(F.col("x").alias("hub"))
    return best.where("led").join(hubs, F.col("best.y") == F.col("hub")).select(F.col("x").alias("node"), F.col("hub").alias("pivot"), F.col("best.apart").alias("apart"))


def _still_mixed(buckets: DataFrame) -> DataFrame:
    """The rows of ``buckets`` (key, id, c), once each, whose key has several components, with their ``members``."""
    rows = buckets.select("key", "id", "c").distinct()
    mixed = rows.groupBy("key").agg(F.count("*").alias("members"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    return rows.join(mixed.where("lo < hi").select("key", "members"), "key")


def _last_pairs(mixed: DataFrame, edges: DataFrame | None, sets: DataFrame, num: int, den: int) -> DataFrame:
    """``a, b``: pairs of ids of the buckets ``mixed`` (key, id, c) that can link and are in different components."""
    if edges is not None:
        limit = 1 - num / den
        pivots = materialize(_pivots(edges, sets, min(limit, num / den / 3)), "pivots")
        radii = pivots.groupBy(F.col("pivot").alias("of")).agg(F.max("apart").alias("radius"))
        widest = pivots.agg(F.max("apart")).first()[0] or 0.0
        led = mixed.join(pivots.withColumnRenamed("apart", "off"), F.col("id") == F.col("node"), "left")
        led = materialize(led.select("key", "id", "c", F.coalesce("pivot", "id").alias("pivot"), F.coalesce("off", F.lit(0.0)).alias("off")), "led")
        by_pivot = materialize(_still_mixed(led.select("key", F.col("pivot").alias("id"), "c")), "by-pivot")
        loose = int((num / den - 2 * widest) * 1000) - 1
        close = _verify(_apart_pairs(by_pivot, sets, loose, 1000).distinct(), sets, loose, 1000)
        for side in ("a", "b"):
            own = radii.select(F.col("of").alias(f"of_{side}"), F.col("radius").alias(f"radius_{side}"))
            close = close.join(own, F.col(side) == F.col(f"of_{side}"), "left").na.fill(0.0, [f"radius_{side}"])
        # Members of two pivots are at most their own distances from these nearer than the pivots are.
        close = materialize(close.where(F.col("apart") <= F.col("radius_a") + F.col("radius_b") + limit + 1e-9), "close")
        least = [F.struct(F.col(p).alias("p"), (F.col("apart") - F.col(f"radius_{q}") - limit - 1e-9).alias("least")) for p, q in ("ab", "ba")]
        least = close.select(F.explode(F.array(*least)).alias("s")).groupBy("s.p").agg(F.min("s.least").alias("least"))
        mixed = led.join(least, (F.col("pivot") == F.col("p")) & (F.col("off") >= F.col("least")))
    return _apart_pairs(materialize(_still_mixed(mixed), "mixed"), sets, num, den)


def prefixes(center: np.ndarray, hashes: np.ndarray, num: int, den: int) -> tuple[bool, np.ndarray, int, int]:
    """(near, the difference, length of its prefix for far partners, for near ones).

    Near sets link with the center, far ones do not. Let d be the sizes of two sets' differences from the center
    and r = (den - num) / (den + num). A link bounds the sets' own difference by r times the sum of their sizes,
    so their differences from the center share (d1 + d2 - r (n1 + n2)) / 2 or more, and two sets that share s
    have one in common in their first d - s + 1 of any order. Against a far set s is above (d + r (nc - n)) / 2;
    a far set shares at least (d - r (n + nc)) / 2, which is above 0, with any. Two near sets are in one component by
    the center.
    """
    differ, p, q = np.setxor1d(center, hashes, assume_unique=True), den - num, den + num
    apart = len(differ)
    near = q * apart <= p * (len(hashes) + len(center))
    for_far = apart - (q * apart + p * (len(center) - len(hashes))) // (2 * q)
    for_near = 0 if near else apart + 1 + (p * (len(hashes) + len(center)) - q * apart) // (2 * q)
    return near, differ, for_far, for_near


def _rare_first(differ: DataFrame) -> DataFrame:
    """The rows of ``differ`` once per shingle that another one holds as well, with its place ``nth``.

    The more sets differ from a center in a shingle, the later it comes (ties: the smaller key first). What only one
    holds is in no pair, but takes the first places, so that prefixes are mostly made of it.
    """
    each = differ.withColumn("key", F.explode("keys")).drop("keys")
    held = each.groupBy(F.col("key").alias("shared")).agg(F.count("*").alias("held")).where("held > 1")
    last = Window.partitionBy("id", "row").orderBy(F.desc("held"), F.desc("key"))
    # Rows that are equal get equal places.
    ranked = each.join(held, F.col("key") == F.col("shared")).withColumn("nth", F.col("apart") - F.dense_rank().over(last))
    return ranked.where("nth < greatest(for_far, for_near)").drop("shared", "held")


def _apart_pairs(buckets: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """``a, b``: pairs of ids that can link, of ``buckets`` (key, members, id, c) with members in several components c.

    All pairs of a bucket of few ``members``; those of a larger one are compared with one of them, the center, and
    meet again only by what they differ in, the rarest first.
    The member of the most buckets is the center, so that few centers do.
    """
    few, many = (buckets.where(rule).select("key", "id") for rule in (f"members <= {FEW}", f"members > {FEW}"))
    plain = few.join(few.toDF("key2", "id2"), F.expr("key = key2 and id < id2")).select("id", "id2")
    held = many.groupBy("id").agg(F.count("*").alias("held")).withColumnRenamed("id", "of")
    center = F.max_by("id", F.struct("held", F.xxhash64("id"))).alias("a")
    centers = many.join(held, F.col("id") == F.col("of")).groupBy("key").agg(center)
    spokes = many.join(centers, "key").where("id <> a").select("a", F.col("id").alias("b")).distinct()
    schema = "id long, row long, n long, near boolean, apart long, for_far long, for_near long, keys array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for met in _beside(batches):
            out, keys = [], [np.zeros(0, np.int64)]
            for a, b, hashes, others in met:
                for other in others:
                    near, tokens, for_far, for_near = prefixes(other, hashes, num, den)
                    # An id may stand for several sets: a key belongs to a center's set, a row to that and a member's set.
                    about = mix(np.bitwise_xor.reduce(mix(other), keepdims=True) + _U(a & (2**64 - 1)))
                    row = mix(np.bitwise_xor.reduce(mix(hashes), keepdims=True) + about).view(np.int64)[0]
                    out.append((b, row, len(hashes), near, len(tokens), for_far, for_near))
                    keys.append(mix(tokens ^ mix(about)).view(np.int64))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
            ends = pa.array(np.cumsum([len(x) for x in keys]), pa.int32())
            arrays = [pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)]
            arrays.append(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(keys))))
            names = ["id", "row", "n", "near", "apart", "for_far", "for_near", "keys"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    own = buckets.select("id", "c").distinct()
    differ = _met(spokes, sets).mapInArrow(run, schema).join(own.withColumnRenamed("id", "of"), F.col("id") == F.col("of")).drop("of")
    differ = materialize(differ, "differ")
    placed = materialize(_rare_first(differ), "placed")
    # Any set seeks far ones: a near one in their longer prefixes, of two far ones the smaller id in the shorter ones.
    left = placed.where("nth < for_far").select("id", "n", "near", "apart", "c", "key", "nth")
    right = placed.where("not near").select(
        F.col("id").alias("id2"), F.col("n").alias("n2"), F.col("apart").alias("apart2"), F.col("c").alias("c2"),
        F.col("key").alias("key2"), F.col("nth").alias("nth2"), F.col("for_far").alias("for_far2"),
    )
    turn = F.col("near") | (F.col("id") < F.col("id2")) & (F.col("nth2") < F.col("for_far2"))
    # What two sets share is at most what follows their first common place.
    least = F.col("apart") + F.col("apart2") - F.lit(den - num) / F.lit(den + num) * (F.col("n") + F.col("n2"))
    most = F.least(F.col("apart") - F.col("nth"), F.col("apart2") - F.col("nth2"))
    sized = F.least("n", "n2") * den >= F.greatest("n", "n2") * num
    met = left.join(right, (F.col("key") == F.col("key2")) & (F.col("c") != F.col("c2")) & turn & sized & (2 * most >= least - 1e-6))
    sides = met.select(F.col("id").alias("x"), F.col("id2").alias("y")).union(spokes).union(plain)
    sides = sides.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    sides = sides.join(own.toDF("oa", "ca"), F.col("a") == F.col("oa")).join(own.toDF("ob", "cb"), F.col("b") == F.col("ob"))
    return sides.where("ca <> cb").select("a", "b")


def link_components(
    docs: DataFrame, width: int, num: int, den: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; ``num`` / ``den`` is the least similarity."""
    source = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    sketched = materialize(_sketches(source, width, num, den), "sketches")
    alike = sketched.where("id is not null and n > 0").groupBy("digest").agg(F.min("id").alias("head"))
    first = sketched.join(alike.select("digest", F.col("head").alias("id")), ["digest", "id"], "left_semi")
    shared = _shared_blocks(first)
    members = materialize(sketched.select("id", "n", "digest"), "members")
    alike = materialize(alike, "classes")
    discard(sketched)
    release(docs.sparkSession)
    involved = shared.select("id").distinct()

    def set_rows(batch: pa.RecordBatch) -> Iterator[dict]:
        sets = [shingles(t, width).tobytes() for t in batch["text"].to_pylist()]
        yield {"id": batch["id"], "hashes": pa.array(sets, pa.binary())}

    texts = source.join(involved, "id", "left_semi").dropDuplicates(["id", "text"])
    sets = materialize(map_arrow(texts, set_rows, "id long, hashes binary"), "sets")

    edges = checked = None
    found = docs.sparkSession.createDataFrame([], "node long, component long")
    for turn in range(STAR_ROUNDS + 1):
        buckets = shared.join(found, F.col("id") == F.col("node"), "left").select(
            "key", "id", "n", F.coalesce("component", "id").alias("c")
        )
        if turn == 0:  # each document is a component of its own
            centers = shared.groupBy("key").agg(F.min(F.struct("id", "n", F.col("id").alias("c"))).alias("center"))
        else:
            order = F.struct(F.xxhash64("c", F.lit(turn)).alias("o"), "id", "n", "c")
            mixed = buckets.groupBy("key").agg(F.min(order).alias("center"), F.min("c").alias("lo"), F.max("c").alias("hi"))
            centers = mixed.where("lo < hi").select("key", "center")
        if turn < STAR_ROUNDS:
            # One bucket a document: of copies most buckets are alike, so any serves as well as the others.
            one = F.min_by(F.struct("key", "n", "c"), F.xxhash64("key", "id", F.lit(turn))).alias("b")
            apart = centers.select(F.col("key").alias("k"), F.col("center.c").alias("cc"))
            rows = buckets if turn == 0 else buckets.join(apart, F.expr("key = k and c <> cc"))
            chosen = rows.groupBy("id").agg(one).select("id", "b.*")
            pairs = chosen.join(centers, "key").select("center.id", "center.n", "id", "n").toDF("x", "nx", "y", "ny")
            pairs = pairs.where((F.least("nx", "ny") * den >= F.greatest("nx", "ny") * num) & (F.col("x") != F.col("y")))
            # The smaller id is the one that is copied to its pairs: originals come before their copies.
            pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        else:
            left = materialize(_still_mixed(buckets), "left")
            if left.isEmpty():
                break
            pairs = _last_pairs(left.select("key", "id", "c"), edges, sets, num, den)
        pairs = pairs.distinct()
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        if pairs.isEmpty():
            continue
        new = materialize(_verify(pairs, sets, num, den), "edges")
        edges = new if edges is None else edges.union(new)
        checked = pairs if checked is None else checked.union(pairs)
        if not new.isEmpty():
            found = materialize(components(edges.select("a", "b")), "components")
        release(docs.sparkSession)
    discard(shared, sets, *([edges, checked] if edges is not None else []))
    # By class: its head's component; the component's name is its smallest id.
    heads = alike.join(found, F.col("head") == F.col("node"), "left").select(
        F.col("digest").alias("d"), F.coalesce("component", "head").alias("component_id")
    )
    named = members.join(heads, F.col("digest") == F.col("d"), "left")
    same = F.when(F.col("id").isNull(), None).when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return named.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), same.alias("component_id"))


def keep_one(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """``docs`` with the smallest id of each group of linked documents; rows without an id stay."""
    of = link_components(docs, width, num, den)
    gone = of.where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
