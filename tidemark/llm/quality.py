"""Quality classifier by positive-unlabelled learning.

A small network on text statistics minimises the non-negative unbiased risk: with the class prior p, the
risk of unlabelled rows taken as negative, less p times that of the trusted positives taken as negative,
must not fall below zero; where it does, its gradient is reversed. The prior is estimated by the best
bin: of all score thresholds, the least ratio of unlabelled to positive rows above it.

Positives are rows labelled 1 in the learning fold, the web text is the fold's rows without a label;
labels of 0 are not used. Both samples are bounded (``POSITIVES``, ``UNLABELLED``) and chosen by a hash of
the id. Scores depend on the text alone.

Defined results: null and empty texts get the score of the empty text. Without positives or without
unlabelled rows every score is 0.5. Rows with a null id are scored but not learned from; repeated rows each
get their row. Repeated labels of an id count once, the largest. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow

#: Rows of either kind that are learned from at most.
POSITIVES, UNLABELLED = 12_000, 24_000

_SYMBOLS = re.compile(r"[#$%&*@^~<>{}\[\]=+_\\/]+")
_COUNTED = ("!", "?", ".", ",", "|", "\n", " ")


def features(text: str) -> list[float]:
    """Statistics of a whole text, of bounded size whatever its length."""
    chars = len(text) or 1
    words = text.split()
    n = len(words) or 1
    kinds = set(words)
    lines = text.split("\n")
    filled = [x for x in lines if x.strip()]
    counts = [text.count(c) / chars for c in _COUNTED]
    symbols = sum(map(len, _SYMBOLS.findall(text))) / chars
    upper = sum(map(str.isupper, words)) / n
    titled = sum(map(str.istitle, words)) / n
    alphabetic = sum(map(str.isalpha, words)) / n
    again = sum(map(str.__eq__, words, words[1:])) / n
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    shares = [
        *counts, symbols, upper, titled, alphabetic, again,
        len(kinds) / n,
        1 - len(set(filled)) / (len(filled) or 1),
        float((lengths == 1).mean()), float((lengths > 12).mean()),
    ]
    sizes = [np.log1p(chars), np.log1p(n), np.log1p(len(lines)), lengths.mean(), lengths.std(), len(kinds) / n**0.8]
    return [*sizes, *shares, *[float(np.log(1e-3 + s)) for s in shares]]


@dataclass
class Model:
    """Standardised inputs, one hidden layer; ``weights`` is None where nothing could be learned."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray] | None
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        w1, b1, w2, b2 = self.weights
        z = np.tanh(self._inputs(x) @ w1 + b1) @ w2 + b2
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)


def _forward(w: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = np.tanh(x @ w[0] + w[1])
    return h, h @ w[2] + w[3]


def _backward(w: list[np.ndarray], x: np.ndarray, h: np.ndarray, dz: np.ndarray) -> list[np.ndarray]:
    dh = np.outer(dz, w[2]) * (1 - h * h)
    return [x.T @ dh, dh.sum(0), h.T @ dz, np.array(dz.sum())]


def _train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int, hidden: int, seed: int, plain: bool) -> list[np.ndarray]:
    """Adam on the sigmoid loss; ``plain`` takes unlabelled rows as negatives and no prior."""
    rng = np.random.default_rng(seed)
    d = positive.shape[1]
    w = [rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.array(0.0)]
    m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    batches = max(1, (len(positive) + len(unlabelled)) // 1024)
    for _ in range(max(epochs, 600 // batches)):  # a small sample needs its steps, too
        ps = np.array_split(rng.permutation(len(positive)), batches)
        us = np.array_split(rng.permutation(len(unlabelled)), batches)
        for p_rows, u_rows in zip(ps, us, strict=True):
            if not len(p_rows) or not len(u_rows):
                continue
            x = np.concatenate([positive[p_rows], unlabelled[u_rows]])
            h, z = _forward(w, x)
            k, s = len(p_rows), 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            slope = s * (1 - s)
            dz = np.zeros(len(x))
            if plain:
                dz[:k] = (s[:k] - 1) / k
                dz[k:] = s[k:] / len(u_rows)
            else:
                # loss of z as positive is 1 - s, as negative s
                negative = s[k:].mean() - prior * s[:k].mean()
                if negative >= 0:
                    dz[:k] = -2 * prior * slope[:k] / k
                    dz[k:] = slope[k:] / len(u_rows)
                else:  # over-fitted: step back on the negative part only
                    dz[:k] = prior * slope[:k] / k
                    dz[k:] = -slope[k:] / len(u_rows)
            grads = _backward(w, x, h, dz)
            step += 1
            for i, g in enumerate(grads):
                g = g + 1e-4 * w[i]
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] = w[i] - 0.01 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return w


def best_bin_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Least ratio of unlabelled to positive rows above a score, over thresholds that enough positives pass."""
    p, u = np.sort(positive)[::-1], np.sort(unlabelled)
    shares = np.arange(1, len(p) + 1) / len(p)
    above = 1 - np.searchsorted(u, p, side="left") / len(u)
    slack = np.sqrt(np.log(20) / 2) * (len(u) ** -0.5 + len(p) ** -0.5)
    at = np.argmin((above + slack) / shares)
    return float(np.clip(above[at] / shares[at], 0.02, 0.98))


def learn(positive: np.ndarray, unlabelled: np.ndarray, epochs: int = 40, hidden: int = 24, seed: int = 7) -> Model:
    """Fit on two feature matrices."""
    d = len(features(""))
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(d), np.ones(d), None, 0.5)
    both = np.concatenate([positive, unlabelled])
    model = Model(both.mean(0), both.std(0) + 1e-6, None, 0.5)
    p, u = model._inputs(positive), model._inputs(unlabelled)
    # The prior needs scores of rows that were not learned from: one half is held back for it.
    half = [a[::2] for a in (p, u)], [a[1::2] if len(a) > 1 else a for a in (p, u)]
    w = _train(*half[0], 0.5, max(5, epochs // 4), hidden, seed, True)
    model.prior = best_bin_prior(*[_forward(w, a)[1] for a in half[1]])
    model.weights = _train(p, u, model.prior, epochs, hidden, seed, False)
    return model


def held_out(doc_id) -> F.Column:
    """The third of ids whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """Learn from bounded samples of the learning fold."""
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).where(
        F.col("id").isNotNull() & ~held_out(F.col("id"))
    )
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col("quality").alias("quality"))
        .where(F.col("l_id").isNotNull() & ~held_out(F.col("l_id")))
        .groupBy("l_id")
        .agg(F.max("quality").alias("quality"))
    )
    order = [F.xxhash64("id"), F.col("id")]
    ids = texts.select("id").distinct().join(marked, F.col("id") == F.col("l_id"), "left")
    positive = ids.where("quality = 1").orderBy(*order).limit(POSITIVES).select("id", F.lit(True).alias("positive"))
    web = ids.where("l_id is null").orderBy(*order).limit(UNLABELLED).select("id", F.lit(False).alias("positive"))
    chosen = positive.unionByName(web)
    sample = texts.join(chosen, "id").select("id", "positive", F.coalesce("text", F.lit("")).alias("text"))

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        x = np.array([features(t) for t in batch["text"].to_pylist()], dtype=np.float32)
        yield {
            "id": batch["id"],
            "positive": batch["positive"],
            "x": pa.array([row.tobytes() for row in x], pa.binary()),
        }

    rows = map_arrow(sample, run, "id long, positive boolean, x binary").toArrow()
    d = len(features(""))
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), dtype=np.float32).reshape(-1, d).astype(np.float64)
    is_positive = np.array(rows["positive"].to_pylist(), dtype=bool)
    # the same samples in the same order give the same model, however the rows arrive
    order_by = np.lexsort((*x.T, np.array(rows["id"].to_pylist(), dtype=np.int64)))
    x, is_positive = x[order_by], is_positive[order_by]
    return learn(x[is_positive], x[~is_positive])


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    return _scored(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.expr("int(score >= 0.5)").alias("predicted")
    )


def _scored(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with ``score`` in place of ``text``."""
    names = [n for n in rows.columns if n != "text"]

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        x = np.array([features(t or "") for t in batch["text"].to_pylist()], dtype=np.float32)
        yield {n: batch[n] for n in names} | {"score": pa.array(model.scores(x.astype(np.float64)))}

    schema = rows.select(*names).schema.add("score", "double")
    return map_arrow(rows, run, schema)


def keep_good(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not reject."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    scored = _scored(docs.select(row, F.col(text).alias("text")), model)
    return scored.where("score >= 0.5").select(*[F.col("row")[c].alias(c) for c in docs.columns])
