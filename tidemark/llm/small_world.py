"""Embedding near-dedup by hierarchical navigable small-world graphs, one per shard.

Vectors are dealt to shards by a hash; each shard builds a graph, and every vector searches every shard's.
A search starts beside the vector's place in several orders of the shard's nodes, by the sides of random planes they
lie on, and goes along the links of the base layer: small groups in a large shard are hard to reach from the top alone. At
first it goes on only if one of these nodes is within twice the angle of a link, as no other is linked to what is linked
to the vector. If an audit fails, every search goes on, and starts from the top layer as well.
A beam that is half full of vectors above the threshold is widened for that query until its second half is below it. The
width that all queries start with is audited: for a sample of all vectors, and one of vectors for which few links were
found, brute force over all rows says how many links there are, and the width doubles until enough of each vector's
are found, on the average over the linked ones of either sample. So a large group cannot hide what small ones miss. What
is found is verified by its cosine in double precision, counted per vector, and joined to components through a spanning
forest of each task. Vectors with different numbers of components have graphs of their own.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing, and vectors
with different numbers of components do not link with each other. Equal vectors are one
node of a graph and link with each other. Rows that share an id are one to the components; each gets its
row. Rows with a null id have no links, no component and aren't kept. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, map_arrow
from tidemark.llm.components import components
from tidemark.session import discard, materialize

#: Links chosen for a new node (as many places are kept for links back), and the beam that chooses them.
DEGREE, BUILD_BEAM = 10, 40
#: First beam of a search, share of its links that an audit must find of a vector, vectors of a sample, and links that are few.
BEAM, RECALL, AUDITED, FEW_LINKS = 16, 0.995, 400, 3
#: Shards at least, vectors of a shard at most, queries that one task runs, about (each task of a shard gets a copy of its graph).
SHARDS, SHARD_SIZE, TASK_QUERIES = 8, 200_000, 200_000
#: Queries searched side by side, beam entries expanded at once, queries that a task gathers, and edges it holds before a forest leaves.
SIDE_BY_SIDE, EXPANDED, GATHERED, HELD_EDGES = 256, 3, 4096, 20_000
#: Orders for each place of the beam, planes of an order, and nodes taken before and after a query's place.
ORDERS, PLANES, BESIDE = 2, 24, 2


def beam_search(
    vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int, seen: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, cosines) of each query's ``beam`` best, best first; missing ones are -1.

    ``links``: neighbours of each node, -1 where there is none. ``entry``: different start nodes of each query, -1 where there
    is none. ``seen``: a row of False for each query, a column for each node and one more; they are False again at
    the end. All queries step together; one whose beam holds no unexpanded node is finished.
    """
    n_queries = len(queries)
    nodes = np.full((n_queries, beam), -1, np.int64)
    cosines = np.full((n_queries, beam), -np.inf, np.float32)
    done = np.ones((n_queries, beam), bool)
    rows = np.arange(n_queries)
    first = np.where(entry >= 0, np.einsum("qed,qd->qe", vectors[entry], queries), -np.inf)
    best = np.argsort(-first, axis=1, kind="stable")[:, :beam]
    entry, first = np.take_along_axis(entry, best, 1), np.take_along_axis(first, best, 1)
    marked = [(rows[:, None], entry)]  # the last column takes the missing ones
    w = entry.shape[1]
    nodes[:, :w] = entry
    cosines[:, :w] = first
    done[:, :w] = entry < 0
    seen[rows[:, None], entry] = True
    live = rows
    while len(live):
        open_cosines = np.where(done[live], -np.inf, cosines[live])
        pick = np.argsort(-open_cosines, axis=1)[:, :EXPANDED]
        picked = np.take_along_axis(open_cosines, pick, 1) > -np.inf
        going = picked.any(1)
        live, pick, picked = live[going], pick[going], picked[going]
        if not len(live):
            break
        done[live[:, None], pick] = True
        new = np.where(picked[..., None], links[nodes[live[:, None], pick]], -1).reshape(len(live), -1)
        new = np.sort(new, axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        r, c = np.nonzero((new >= 0) & ~seen[live[:, None], new])
        at = new[r, c]
        seen[live[r], at] = True
        marked.append((live[r], at))
        found = np.einsum("id,id->i", vectors[at], queries[live[r]])
        # What is not among the best of its beam cannot enter it.
        better = found > cosines[live[r], -1]
        r, at, found = r[better], at[better], found[better]
        # The columns hold what is left of each row, one after the other.
        c = np.arange(len(r)) - np.searchsorted(r, r, side="left")
        new = np.full((len(live), int(c.max(initial=-1)) + 1), -1, np.int64)
        sims = np.full(new.shape, -np.inf, np.float32)
        new[r, c], sims[r, c] = at, found
        all_nodes = np.concatenate([nodes[live], new], 1)
        all_cosines = np.concatenate([cosines[live], sims], 1)
        all_done = np.concatenate([done[live], new < 0], 1)
        best = np.argsort(-all_cosines, axis=1, kind="stable")[:, :beam]
        nodes[live] = np.take_along_axis(all_nodes, best, 1)
        cosines[live] = np.take_along_axis(all_cosines, best, 1)
        done[live] = np.take_along_axis(all_done, best, 1)
        nodes[live] = np.where(np.isfinite(cosines[live]), nodes[live], -1)
    for row, node in marked:
        seen[row, node] = False
    return nodes, cosines


def _spread(vectors: np.ndarray, nodes: np.ndarray, cosines: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` neighbours: those nearer to the new node than to one chosen before, then the nearest rest."""
    near = vectors[nodes]
    between = np.einsum("qed,qfd->qef", near, near)
    chosen = np.zeros(nodes.shape, bool)
    for j in range(nodes.shape[1]):
        blocked = (chosen & (between[:, j] > cosines[:, j, None])).any(1)
        chosen[:, j] = ~blocked & (nodes[:, j] >= 0) & (chosen.sum(1) < count)
    # First the chosen, then the others, each by nearness; missing ones come last.
    rank = np.where(nodes < 0, 3.0, np.where(chosen, 0.0, 1.0))
    order = np.argsort(rank, axis=1, kind="stable")[:, :count]
    return np.take_along_axis(nodes, order, 1)


class Orders:
    """Nodes sorted ``count`` times by the sides of random planes that they lie on, so that close ones often stand together."""

    def __init__(self, vectors: np.ndarray, count: int, seed: int = 2) -> None:
        self.count = count
        self.planes = np.random.default_rng(seed).normal(size=(vectors.shape[1], count * PLANES)).astype(np.float32)
        # Planes go through the middle of the nodes, which need not be near the origin.
        self.middle = vectors.mean(0, dtype=np.float64).astype(np.float32) @ self.planes
        codes = self.codes(vectors)
        self.nodes = np.stack([np.argsort(c, kind="stable") for c in codes]).astype(np.int32)
        self.sorted = np.take_along_axis(codes, self.nodes, 1)

    def codes(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((self.count, len(x)), np.int32)
        for at in range(0, len(x), GATHERED):
            sides = (x[at : at + GATHERED] @ self.planes > self.middle).reshape(-1, self.count, PLANES)
            octets = np.packbits(sides, axis=2).astype(np.int32)
            out[:, at : at + GATHERED] = sum(octets[..., i] << 8 * (PLANES // 8 - 1 - i) for i in range(PLANES // 8)).T
        return out

    def beside(self, queries: np.ndarray) -> np.ndarray:
        """The nodes next to each query's place in every order; some come several times."""
        places = np.stack([np.searchsorted(held, code) for held, code in zip(self.sorted, self.codes(queries), strict=True)], 1)
        at = np.clip(places[..., None] + np.arange(-BESIDE, BESIDE), 0, self.nodes.shape[1] - 1)
        return self.nodes[np.arange(self.count)[:, None], at].reshape(len(queries), -1)


class Graph:
    """Layered graph over unit vectors. Layer l holds the nodes of level l and above."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray] | None = None, entry: int = 0) -> None:
        self.vectors, self.links, self.entry = vectors, links or [], entry
        self.seen = np.zeros((SIDE_BY_SIDE, len(vectors) + 1), bool)
        self.orders: Orders | None = None

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 1) -> Graph:
        n = len(vectors)
        levels = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(DEGREE)).astype(np.int64)
        order = np.argsort(-levels, kind="stable")
        graph = cls(vectors, [np.full((n, 2 * DEGREE), -1, np.int64) for _ in range(int(levels.max(initial=0)) + 1)], int(order[0]))
        for layer in range(len(graph.links) - 1, -1, -1):
            members = order[levels[order] >= layer]
            at = 1
            while at < len(members):
                # Early nodes go in alone or in small groups, as there is little to search yet.
                batch = members[at : at + min(SIDE_BY_SIDE, max(1, at // 4))]
                graph._insert(layer, batch)
                at += len(batch)
        return graph

    def _descend(self, queries: np.ndarray, layer: int) -> np.ndarray:
        """Start nodes for ``layer``: the best of each layer above."""
        entry = np.full((len(queries), 1), self.entry, np.int64)
        for above in range(len(self.links) - 1, layer, -1):
            entry = beam_search(self.vectors, self.links[above], queries, entry, 2, self.seen)[0]
        return entry

    def _insert(self, layer: int, batch: np.ndarray) -> None:
        links, own = self.links[layer], self.vectors[batch]
        nodes, cosines = beam_search(self.vectors, links, own, self._descend(own, layer), BUILD_BEAM, self.seen)
        itself = nodes == batch[:, None]
        nodes, cosines = np.where(itself, -1, nodes), np.where(itself, -np.inf, cosines)
        if len(batch) > 1:  # those that go in together see the ones before them
            peers = np.tril(np.ones((len(batch), len(batch)), bool), -1)
            sims = np.where(peers, own @ own.T, -np.inf)
            top = np.argsort(-sims, axis=1)[:, :DEGREE]
            sims = np.take_along_axis(sims, top, 1)
            nodes = np.concatenate([nodes, np.where(np.isfinite(sims), batch[top], -1)], 1)
            cosines = np.concatenate([cosines, sims], 1)
        best = np.argsort(-cosines, axis=1, kind="stable")[:, :BUILD_BEAM]
        nodes, cosines = np.take_along_axis(nodes, best, 1), np.take_along_axis(cosines, best, 1)
        nodes = np.where(np.isfinite(cosines), nodes, -1)
        links[batch, :DEGREE] = _spread(self.vectors, nodes, cosines, DEGREE)
        # Links back: a free place, or that of the farthest link back if the new node is nearer.
        for node, row in zip(batch.tolist(), links[batch, :DEGREE].tolist(), strict=True):
            for other in row:
                if other < 0:
                    continue
                back = links[other, DEGREE:]
                free = np.flatnonzero(back < 0)
                if len(free):
                    back[free[0]] = node
                    continue
                sims = self.vectors[back] @ self.vectors[other]
                worst = int(sims.argmin())
                if self.vectors[node] @ self.vectors[other] > sims[worst]:
                    back[worst] = node

    def _beside(self, queries: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, cosines) beside the queries in ``count`` orders, the best first; repeated ones are -1."""
        if self.orders is None or self.orders.count != count:
            self.orders = Orders(self.vectors, count)
        nodes = np.sort(self.orders.beside(queries), axis=1).astype(np.int64)
        cosines = np.empty(nodes.shape, np.float32)
        for at in range(0, len(queries), 64):  # so that what is gathered stays in the cache
            part = slice(at, at + 64)
            cosines[part] = np.matmul(self.vectors[nodes[part]], queries[part, :, None])[..., 0]
        cosines[:, 1:][nodes[:, 1:] == nodes[:, :-1]] = -np.inf
        return nodes, cosines

    def near(self, queries: np.ndarray, beam: int, least: float, short: bool) -> Iterator[tuple[int, np.ndarray]]:
        """(query, nodes with a cosine of about ``least`` or more) of each query that has any; beams half full of them are widened.

        ``short``: start from the orders only, and leave out queries that have no node there that may be linked to a hit.
        """
        reach = 2 * least * least - 1 if short and least > 0 else -np.inf
        nodes, cosines = self._beside(queries, ORDERS * beam)
        live = np.flatnonzero((cosines >= reach).any(1))
        best = np.argsort(-cosines[live], axis=1, kind="stable")
        entry = np.where(np.isfinite(np.take_along_axis(cosines[live], best, 1)), np.take_along_axis(nodes[live], best, 1), -1)
        for at in range(0, len(live), SIDE_BY_SIDE):
            part = slice(at, at + SIDE_BY_SIDE)
            todo, start, wide = live[part], entry[part], beam
            if not short:
                top = self._descend(queries[todo], 0)
                start = np.concatenate([np.where((top[:, :1] == start).any(1, keepdims=True), -1, top[:, :1]), start], 1)
            # Half of a beam is left to nodes that lead on to further hits.
            while len(todo):
                wide = min(wide, len(self.vectors))
                nodes, cosines = beam_search(self.vectors, self.links[0], queries[todo], start, wide, self.seen)
                hits = (cosines >= least) & (nodes >= 0)
                full = hits[:, (wide - 1) // 2] & (wide < len(self.vectors))
                for i in np.flatnonzero(~full & hits.any(1)):
                    yield int(todo[i]), nodes[i, hits[i]]
                todo, start, wide = todo[full], start[full], wide * 2


def unit(x: np.ndarray) -> np.ndarray:
    return (x / np.sqrt((x * x).sum(1))[:, None]).astype(np.float32)


def _rows(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Vectors from their bytes: floats of 64 bits, or of 32 where these are exact."""
    raw = column.to_pylist()
    for kind, size in ((np.float32, 4 * dim), (np.float64, 8 * dim)):
        if all(len(v) == size for v in raw):
            return np.frombuffer(b"".join(raw), kind).reshape(-1, dim).astype(np.float64)
    return np.stack([np.frombuffer(v, np.float32 if len(v) == 4 * dim else np.float64) for v in raw]).astype(np.float64)


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``id, v`` of the rows that can link."""
    v = F.col("v")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
    rows = rows.where(~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return rows.where(F.exists(v, lambda x: x != 0))


def _as_bytes(rows: DataFrame, dim: int) -> DataFrame:
    """``id, size, v`` with the bytes that ``_rows`` reads."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        x = batch["v"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        with np.errstate(over="ignore"):
            small = x.astype(np.float32)
        short = (small == x).all(1)
        raw = [(a if s else b).tobytes() for a, b, s in zip(small, x, short, strict=True)]
        yield {"id": batch["id"], "size": batch["size"], "v": pa.array(raw, pa.binary())}

    return map_arrow(rows, run, "id long, size long, v binary")


def build_graphs(nodes: DataFrame, dim: int, shards: int) -> DataFrame:
    """``shard, node, id, size, v, links``: every shard's graph, a row per node, all layers in ``links``."""
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    schema = pa.schema(
        [("shard", pa.int32()), ("node", pa.int64()), ("id", pa.int64()), ("size", pa.int64()), ("v", pa.binary()), ("links", pa.binary())]
    )

    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by("id")
        x = unit(_rows(part["v"], dim))
        graph = Graph.build(x)
        lists = [row.tobytes() for row in np.stack(graph.links, 1).astype("<i4")]  # layer by layer
        return pa.table(
            [part["shard"].combine_chunks().cast(pa.int32()), pa.array(np.arange(len(x))), part["id"], part["size"], part["v"], pa.array(lists, pa.binary())],
            names=schema.names,
        ).cast(schema)

    return dealt.groupBy("shard").applyInArrow(run, "shard int, node long, id long, size long, v binary, links binary")


class _Shard:
    """A shard's graph from its rows, sorted by node."""

    def __init__(self, rows: list[pa.RecordBatch], dim: int) -> None:
        held = pa.Table.from_batches(rows)
        self.ids, self.sizes, self.x = held["id"].to_numpy(), held["size"].to_numpy(), _rows(held["v"], dim)
        self.norms = np.sqrt((self.x * self.x).sum(1))
        layers = np.frombuffer(b"".join(held["links"].to_pylist()), "<i4").reshape(len(self.ids), -1, 2 * DEGREE)
        links = [layers[:, i].astype(np.int64) for i in range(layers.shape[1])]
        # The entry is a node of the top layer; any with a link there will do, or the only one.
        top = np.flatnonzero((links[-1] >= 0).any(1))
        self.graph = Graph(unit(self.x), links, int(top[0]) if len(top) else _entry(links))

    def found(self, ids: np.ndarray, x: np.ndarray, beam: int, least: float, short: bool) -> Iterator[tuple[int, np.ndarray]]:
        """(row of the query, nodes) with verified cosines, the query's own node left out."""
        norms = np.sqrt((x * x).sum(1))
        for i, nodes in self.graph.near(unit(x), beam, least - 1e-4, short):
            nodes = nodes[self.ids[nodes] != ids[i]]
            exact = (self.x[nodes] @ x[i]) / (self.norms[nodes] * norms[i])
            nodes = nodes[exact >= least]
            if len(nodes):
                yield i, nodes


def _entry(links: list[np.ndarray]) -> int:
    for layer in reversed(links):
        linked = np.flatnonzero((layer >= 0).any(1))
        if len(linked):
            return int(linked[0])
    return 0


def _own_tasks(spark: SparkSession, n: int) -> Column:
    """A key for each ``place`` from 0 to n - 1 that ``repartition(n, key)`` deals to a partition of its own."""
    hashed = spark.range(64 * n).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("p")).groupBy("p").agg(F.min("id").alias("id"))
    keys = sorted(r["id"] for r in hashed.collect())
    keys += range(64 * n, 65 * n - len(keys))
    return F.element_at(F.array(*map(F.lit, keys)), F.col("place") + 1).cast("long")


def search_graphs(graphs: DataFrame, queries: DataFrame, dim: int, shards: int, beam: int, least: float, short: bool = False) -> DataFrame:
    """``kind, a, b``: for kind 0 the number b of vectors linked to query a in a shard, for kind 1 an edge.

    A task gets a shard's graph and then its queries, batch by batch; of the edges it found it gives a
    spanning forest, so a dense group leaves it as one edge per member.
    """
    bound_batches(graphs.sparkSession)
    n = queries.count()
    parts = max(1, -(-n // TASK_QUERIES))
    none = F.lit(None)
    nodes = graphs.select(
        F.explode(F.sequence(F.col("shard") * parts, F.col("shard") * parts + parts - 1)).alias("place"), "node", "id", "size", "v", "links"
    )
    asked = queries.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).cast("int")).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("place"), "part",
        none.cast("long").alias("node"), "id", none.cast("long").alias("size"), "v", none.cast("binary").alias("links"),
    ).withColumn("place", F.col("place") * parts + F.col("part")).drop("part")
    dealt = nodes.union(asked).withColumn("task", _own_tasks(graphs.sparkSession, shards * parts)).repartition(shards * parts, "task")
    streams = dealt.sortWithinPartitions("place", F.col("node").asc_nulls_last()).drop("task")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, shard = None, None
        rows: list[pa.RecordBatch] = []
        ids: list[np.ndarray] = []
        xs: list[np.ndarray] = []
        parent: dict[int, int] = {}

        def root(a: int) -> int:
            while (p := parent.setdefault(a, a)) != a:
                parent[a] = a = parent[p]
            return a

        def forest() -> pa.RecordBatch:
            pairs = [(root(a), a) for a in list(parent)]
            parent.clear()
            return _out([(1, r, a) for r, a in pairs if r != a])

        def ask() -> Iterator[pa.RecordBatch]:
            if ids and shard is not None:
                own, counts = np.concatenate(ids), []
                for i, found in shard.found(own, np.concatenate(xs), beam, least, short):
                    counts.append((0, int(own[i]), int(shard.sizes[found].sum())))
                    a = root(int(own[i]))
                    for b in shard.ids[found].tolist():
                        b = root(b)
                        if a != b:
                            a, b = min(a, b), max(a, b)
                            parent[b] = a
                yield _out(counts)
            ids.clear()
            xs.clear()
            if len(parent) > HELD_EDGES:
                yield forest()

        for batch in batches:
            place, is_node = batch["place"].to_numpy(), batch["node"].is_valid().to_numpy(zero_copy_only=False)
            ends = [*(np.flatnonzero((np.diff(place) != 0) | (np.diff(is_node.astype(np.int8)) != 0)) + 1).tolist(), batch.num_rows]
            start = 0
            for end in ends if batch.num_rows else ():
                piece = batch.slice(start, end - start)
                if place[start] != now:
                    yield from ask()
                    now, rows, shard = place[start], [], None
                if is_node[start]:
                    rows.append(piece)
                else:
                    if shard is None and rows:
                        shard, rows = _Shard(rows, dim), []
                    ids.append(piece["id"].to_numpy())
                    xs.append(_rows(piece["v"], dim))
                    if sum(map(len, ids)) >= GATHERED:
                        yield from ask()
                start = end
        yield from ask()
        yield forest()

    return streams.mapInArrow(run, "kind int, a long, b long")


def _out(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["kind", "a", "b"])


def _brute_links(nodes: DataFrame, sample: list[tuple[int, bytes]], dim: int, least: float) -> dict[int, int]:
    """Number of vectors linked to each sampled one, by comparing these with all rows."""
    ids = np.array([r[0] for r in sample], np.int64)
    q = _rows(pa.array([r[1] for r in sample], pa.binary()), dim)
    q_norms = np.sqrt((q * q).sum(1))

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        x, own, sizes = _rows(batch["v"], dim), batch["id"].to_numpy(), batch["size"].to_numpy()
        cosines = (x @ q.T) / np.outer(np.sqrt((x * x).sum(1)), q_norms)
        hits = ((cosines >= least) & (own[:, None] != ids[None])) * sizes[:, None]
        linked = np.flatnonzero(hits.any(0))
        yield {"id": pa.array(ids[linked]), "n": pa.array(hits[:, linked].sum(0).astype(np.int64))}

    return dict(map(tuple, map_arrow(nodes, run, "id long, n long").groupBy("id").agg(F.sum("n")).collect()))


def _enough(nodes: DataFrame, counted: DataFrame, dim: int, least: float) -> bool:
    """Whether either sample's linked vectors have ``RECALL`` of their links among the ``counted`` (id, linked)."""
    every = nodes.join(counted, F.col("id") == F.col("l_id"), "left").select("id", "v", F.coalesce("linked", F.lit(0)).alias("linked"))
    for rows in (every, every.where(F.col("linked").between(1, FEW_LINKS))):
        sample = rows.orderBy(F.xxhash64("id", F.lit(2)), "id").limit(AUDITED).collect()
        if not sample:
            continue
        true = _brute_links(nodes, [(r["id"], bytes(r["v"])) for r in sample], dim, least)
        shares = [min(1.0, r["linked"] / true[r["id"]]) for r in sample if r["id"] in true]
        if shares and np.mean(shares) < RECALL:
            return False
    return True


def linked_vectors(nodes: DataFrame, dim: int, least: float) -> DataFrame:
    """What ``search_graphs`` finds for all ``nodes`` (v, id, size), distinct vectors of ``dim`` components, written."""
    shards = max(SHARDS, -(-nodes.count() // SHARD_SIZE))
    graphs, beam, short = materialize(build_graphs(nodes, dim, shards), "graphs"), BEAM, True
    while True:
        found = materialize(search_graphs(graphs, nodes.select("id", "v"), dim, shards, beam, least, short), "found")
        counted = found.where("kind = 0").groupBy(F.col("a").alias("l_id")).agg(F.sum("b").alias("linked"))
        if beam >= SHARD_SIZE or _enough(nodes, counted, dim, least):
            discard(graphs)
            return found
        discard(found)
        beam, short = beam if short else beam * 2, False


def near_duplicates(vectors: DataFrame, least: float = 0.9, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    rows = usable(vectors, vec_id, embedding)
    # A vector that is alone with its number of components has no partner.
    dims = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy("dim").collect()
    everyone = vectors.select(F.col(vec_id).cast("long").alias("vec_id"))
    if not dims:
        return everyone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    parts = []
    for dim in (r["dim"] for r in dims):
        own = rows.where(F.size("v") == dim).groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("size"))
        nodes = materialize(_as_bytes(own, dim), "vectors")
        parts.append(linked_vectors(nodes, dim, least))
        discard(nodes)
    found = reduce(DataFrame.union, parts)
    links = found.where("kind = 0").groupBy(F.col("a").alias("l_id")).agg(F.sum("b").alias("linked"))
    # Members of a class hang on its smallest id; rows that share an id share a node.
    raw = rows.select("id", "v").join(
        rows.groupBy("v").agg(F.min("id").alias("head"), F.count("*").alias("size")).where("size > 1").withColumnRenamed("v", "hv"),
        F.col("v") == F.col("hv"),
    ).select("id", "head", "size")
    edges = found.where("kind = 1").select("a", "b").union(raw.where("id <> head").select("head", "id"))
    parts = components(edges)
    per_id = (
        rows.select("id").distinct()
        .join(raw.groupBy(F.col("id").alias("r_id")).agg(F.min("head").alias("head"), F.max("size").alias("size")), F.col("id") == F.col("r_id"), "left")
        .select("id", F.coalesce("head", "id").alias("head"), F.coalesce("size", F.lit(1)).alias("size"))
        .join(links, F.col("head") == F.col("l_id"), "left")
        .join(parts, F.col("id") == F.col("node"), "left")
        .select(F.col("id").alias("p_id"), (F.coalesce("linked", F.lit(0)) + F.col("size") - 1).alias("n"), F.coalesce("component", "id").alias("c"))
    )
    return everyone.join(per_id, F.col("vec_id") == F.col("p_id"), "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("c", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("c", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
