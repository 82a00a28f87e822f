"""Exact top-k search by inner product over integer vectors.

Vectors are processed by descending length. All are rotated by the right singular vectors of a sample, so
that the first coordinates hold most of the length; the partial product of those plus the product of the
residual lengths bounds the whole product (Cauchy-Schwarz), and what cannot reach a query's k-th best score
is not multiplied out. The rotation only decides how much is pruned; scores are exact integers.

Queries meet vectors in cells of a query block and a vector group, both of bounded size. Groups are ranges of lengths,
from the longest on. A first pass over the longest vectors gives each query a score to beat; a group whose longest vector
cannot beat the least of a block is not sent to it, and neither is the block.

Defined results: vectors that are null or hold null or non-finite components take no part; shorter vectors
count as padded with zeros. Of rows with an equal id the one with the smallest vector counts; rows with a
null id take no part. Scores beyond 64 bits are cut to that range. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

#: Queries of a block, vectors of a group, vectors of the first pass, numbers of the rotation's sample.
QUERY_BLOCK, VECTOR_GROUP, HEAD, SAMPLE_NUMBERS = 16_384, 8_192, 2_048, 2_000_000
#: Vectors that are bounded and multiplied at once.
STEP = 1_024
_FLOOR, _LIMIT = -(1 << 63), (1 << 63) - 1


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", factor: int = 1024) -> DataFrame:
    """``id, v, norm``: floor(factor * x) per component, of the vectors that take part."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull()).where(~bad)
    rows = rows.select("id", F.transform(v, lambda x: F.floor(x * factor).cast("long")).alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return rows.groupBy("id").agg(F.min("v").alias("v")).withColumn("norm", F.sqrt(squares))


def rotation(rows: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of a bounded sample, chosen by a hash of the id."""
    n = max(1, SAMPLE_NUMBERS // max(1, dim))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(n).select("v").toArrow()
    x = _matrix(sample["v"], dim).astype(np.float64)
    return np.linalg.svd(x, full_matrices=True)[2].T if len(x) <= dim else np.linalg.eigh(x.T @ x)[1][:, ::-1]


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim), np.int64)
    for i, v in enumerate(column):
        values = v.values.to_numpy(zero_copy_only=False)
        out[i, : len(values)] = values
    return out


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products: by floats where these are exact, else by integers."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if most < 2**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if most < 2**63:
        return q @ x.T
    return np.clip(q.astype(object) @ x.T.astype(object), _FLOOR, _LIMIT).astype(np.int64)


def search(
    q_ids: np.ndarray, q: np.ndarray, beat: np.ndarray, x_ids: np.ndarray, x: np.ndarray, rotate: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the query, vector id, score) of each query's best among ``x``.

    ``beat``: a score that k vectors are known to reach; what is below is left out.
    """
    norms = np.sqrt((x.astype(np.float64) ** 2).sum(1))
    order = np.lexsort((x_ids, -norms))
    x_ids, x, norms = x_ids[order], x[order], norms[order]
    w = max(1, q.shape[1] // 4)
    qr, xr = q.astype(np.float64) @ rotate, x.astype(np.float64) @ rotate
    q_norms = np.sqrt((qr**2).sum(1))
    q_rest, x_rest = np.sqrt((qr[:, w:] ** 2).sum(1)), np.sqrt((xr[:, w:] ** 2).sum(1))
    least = beat.astype(np.float64).copy()
    rows, ids, scores = (np.zeros(0, np.int64) for _ in range(3))
    for at in range(0, len(x), STEP):
        slack = 1 + 1e-9 * q_norms * norms[at]  # for rounding in the bounds
        live = np.flatnonzero(q_norms * norms[at] + slack >= least)
        if not len(live):
            break
        part = slice(at, at + STEP)
        bound = qr[live, :w] @ xr[part, :w].T + np.outer(q_rest[live], x_rest[part])
        can = bound + slack[live, None] >= least[live, None]
        some, cols = np.flatnonzero(can.any(1)), np.flatnonzero(can.any(0))
        if not len(some):
            continue
        got = _products(q[live[some]], x[part][cols])
        keep = can[np.ix_(some, cols)] & (got >= least[live[some], None]) & (x_ids[part][cols] != q_ids[live[some], None])
        i, j = np.nonzero(keep)
        rows, ids = np.r_[rows, live[some][i]], np.r_[ids, x_ids[part][cols][j]]
        scores = np.r_[scores, got[i, j]]
        best = np.lexsort((ids, -scores.astype(object) if (scores == _FLOOR).any() else -scores, rows))
        rows, ids, scores = rows[best], ids[best], scores[best]
        heads = np.searchsorted(rows, rows, side="left")
        nth = np.arange(len(rows)) - heads
        rows, ids, scores, nth = (a[nth < k] for a in (rows, ids, scores, nth))
        full = nth == k - 1
        least[rows[full]] = np.maximum(least[rows[full]], scores[full])
    return rows, ids, scores


def _cell(dim: int, rotate: np.ndarray, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        if not queries.num_rows or not vectors.num_rows:
            return schema.empty_table()
        q_ids = queries["id"].to_numpy()
        rows, ids, scores = search(
            q_ids, _matrix(queries["v"], dim), queries["beat"].to_numpy(), vectors["x_id"].to_numpy(), _matrix(vectors["x_v"], dim), rotate, k
        )
        return pa.table([pa.array(q_ids[rows]), pa.array(ids), pa.array(scores)], schema=schema)

    return run


def top_products(vectors: DataFrame, k: int = 10, query_step: int = 100) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best other vectors of each id that ``query_step`` divides."""
    rows = materialize(quantised(vectors), "vectors")
    about = rows.agg(
        F.max(F.size("v")).alias("dim"), F.count("*").alias("n"), F.sum(F.expr(f"int(id % {query_step} = 0)")).alias("q")
    ).first()
    dim, n, n_queries = max(1, about["dim"] or 1), about["n"], about["q"] or 0
    rotate = rotation(rows, dim) if n else np.eye(dim)
    blocks, groups = max(1, -(-n_queries // QUERY_BLOCK)), max(1, -(-n // VECTOR_GROUP))
    cell, schema = _cell(dim, rotate, k), "query_id long, vec_id long, score long"
    queries = rows.where(F.col("id") % query_step == 0).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))

    # First pass: the longest vectors, one group, against every block. The head is bounded, so each block has a copy.
    # The vectors' columns get names of their own, as both sides come from one table.
    x = [F.col("id").alias("x_id"), F.col("v").alias("x_v")]
    head = rows.orderBy(F.desc("norm"), "id").limit(HEAD).select(*x)
    heads = head.select("*", F.explode(_numbers(blocks)).alias("x_block"))
    lowest = F.lit(_FLOOR).cast("long").alias("beat")
    first = (
        queries.select("id", "v", "block", lowest).groupBy("block").cogroup(heads.groupBy("x_block")).applyInArrow(cell, schema)
    )
    reached = first.groupBy("query_id").agg(F.count("*").alias("c"), F.min("score").alias("s")).where(f"c >= {k}")
    ready = materialize(
        queries.join(reached, F.col("id") == F.col("query_id"), "left").select(
            "id", "v", "norm", "block", F.coalesce("s", F.lit(_FLOOR).cast("long")).alias("beat")
        ),
        "queries",
    )

    # A block meets the groups, and of these the vectors, that are long enough for one of its queries.
    needs = ready.groupBy("block").agg(F.min(F.expr("if(norm > 0, beat / norm, if(beat > 0, double('inf'), double('-inf')))")).alias("length"))
    ranged = rows.repartitionByRange(groups, F.desc("norm"), "id").withColumn("x_part", F.spark_partition_id())
    ranged = materialize(ranged.select(*x, F.col("norm").alias("x_norm"), "x_part"), "ranged")
    tops = ranged.groupBy("x_part").agg(F.max("x_norm").alias("top")).select("*", F.explode(_numbers(blocks)).alias("x_block"))
    enough = lambda norm: F.col(norm) * (1 + 1e-9) + 1e-6 >= F.col("length")
    cells = tops.join(needs, F.col("x_block") == F.col("block")).where(enough("top")).select(F.col("x_part").alias("part"), "block", "length")
    dealt = ranged.join(cells, F.col("x_part") == F.col("part")).where(enough("x_norm"))
    dealt = dealt.select("x_id", "x_v", F.col("block").alias("x_block"), "x_part")
    asked = ready.join(cells.select("part", F.col("block").alias("cell_block")), F.col("block") == F.col("cell_block"))
    asked = asked.select("id", "v", "beat", "block", "part")
    best = asked.groupBy("block", "part").cogroup(dealt.groupBy("x_block", "x_part")).applyInArrow(cell, schema)
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
