"""User segments: scaling, choice of k, mixture model, cluster naming."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import log1p_or_zero
from tidemark.session import materialize

# Search range and seed.
MIN_K, MAX_K, SEED = 10, 25, 42
MAX_ITERATIONS, TOLERANCE = 100, 1e-3

# Users that a mixture's start is drawn from, rounds of nearest means there, and what is added to every variance.
START_USERS, START_ROUNDS, FLOOR = 2_000, 10, 1e-6
QUARTILES = (0.25, 0.5, 0.75)
#: Bits of one digit of a value's ordered key.
DIGIT_BITS = 16


def feature_columns(features: DataFrame, key: str = "user_id") -> list[str]:
    return [c for c in features.columns if c != key]


def fill_missing(features: DataFrame, key: str = "user_id") -> DataFrame:
    return features.na.fill(0, subset=feature_columns(features, key))


def log_features(features: DataFrame, key: str = "user_id") -> DataFrame:
    """ln(1+x) of every feature, missing values as 0."""
    filled = fill_missing(features, key)
    return filled.select(key, *[log1p_or_zero(c).alias(c) for c in feature_columns(features, key)])


def _ordered_keys(values: np.ndarray) -> np.ndarray:
    """64-bit unsigned integers in the order of the doubles (0.0 and -0.0 are one)."""
    bits = (values + 0.0).view(np.int64)
    return (bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.uint64) ^ np.uint64(1 << 63)


def _value_of(key: int) -> float:
    bits = np.array([key], np.uint64) ^ np.uint64(1 << 63)
    bits = bits.view(np.int64)
    return float((bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64)[0])


def _digit_counts(df: DataFrame, groups: dict[tuple[str, int], int], digit: int) -> DataFrame:
    """``group, digit, n``: how many values of a feature whose leading digits are the group's have which next digit.

    Digits have 16 bits and count from 0. A task holds one histogram per group.
    """
    names = list(dict.fromkeys(c for c, _ in groups))
    low = 64 - DIGIT_BITS * (digit + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {g: np.zeros(1 << DIGIT_BITS, np.int64) for g in groups.values()}
        for batch in batches:
            for c in names:
                column = batch[c].drop_null().to_numpy(zero_copy_only=False)
                keys = _ordered_keys(column[~np.isnan(column)])
                heads = keys >> np.uint64(low + DIGIT_BITS) if digit else np.zeros(len(keys), np.uint64)
                digits = (keys >> np.uint64(low)) & np.uint64((1 << DIGIT_BITS) - 1)
                for (name, head), g in groups.items():
                    if name == c:
                        counts[g] += np.bincount(digits[heads == np.uint64(head)].astype(np.int64), minlength=1 << DIGIT_BITS)
        for g, n in counts.items():
            seen = np.flatnonzero(n)
            columns = [np.full(len(seen), g, np.int32), seen.astype(np.int32), n[seen]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["group", "digit", "n"])

    rows = df.select(*[F.col(c).cast("double").alias(c) for c in names])
    return rows.mapInArrow(run, "group int, digit int, n long").groupBy("group", "digit").agg(F.sum("n").alias("n"))


def _picker(wanted: dict[int, list]):
    """The digit of each wanted rank of a group, and the rank among the values that have it."""

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("digit")
        last = pdf["n"].cumsum().to_numpy()
        out = []
        for mark, rank, p, side in wanted[int(pdf["group"].iloc[0])]:
            rank = side((last[-1] - 1) * p) if rank is None else rank
            at = int(np.searchsorted(last, rank, side="right"))
            out.append((mark, int(pdf["digit"].iloc[at]), int(rank - (last[at - 1] if at else 0)), int(last[-1])))
        return pd.DataFrame(out, columns=["mark", "digit", "rank", "n"])

    return pick


def exact_quantiles(
    df: DataFrame, names: Sequence[str], probabilities: Sequence[float] = QUARTILES
) -> dict[str, list[float]]:
    """Exact quantiles with linear interpolation, all features and ranks in four aggregates.

    Values are read as 64-bit keys in the same order. Each aggregate counts one digit of 16 bits among the values
    that agree with a wanted rank in the digits before, and so fixes the rank's next digit. Ties of any length are
    counts, nothing is sorted, and the driver gets a digit per rank. Null and NaN values do not count.
    """
    marks = [(c, i, side) for c in names for i in range(len(probabilities)) for side in (math.floor, math.ceil)]
    heads, ranks, rows = dict.fromkeys(marks, 0), {}, {}
    for digit in range(64 // DIGIT_BITS):
        groups = {g: i for i, g in enumerate(sorted({(m[0], heads[m]) for m in marks}))}
        wanted: dict[int, list] = {}
        for j, m in enumerate(marks):
            wanted.setdefault(groups[m[0], heads[m]], []).append((j, ranks.get(m), probabilities[m[1]], m[2]))

        counts = _digit_counts(df, groups, digit)
        for r in counts.groupBy("group").applyInPandas(_picker(wanted), "mark int, digit int, rank long, n long").collect():
            mark = marks[r["mark"]]
            heads[mark] = heads[mark] << DIGIT_BITS | r["digit"]
            ranks[mark] = r["rank"]
            rows.setdefault(mark, r["n"])
    if len(rows) < len(marks):
        raise ValueError("no rows to take quantiles of")
    out: dict[str, list[float]] = {c: [] for c in names}
    for c, i, side in marks[::2]:
        low, high = (_value_of(heads[c, i, f]) for f in (math.floor, math.ceil))
        place = (rows[c, i, side] - 1) * probabilities[i]
        out[c].append(low + (high - low) * (place - math.floor(place)))
    return out


def robust_scaled(features: DataFrame, key: str = "user_id") -> DataFrame:
    """(x - median) / IQR of the log features; a zero IQR only centers."""
    logged = log_features(features, key)
    quartiles = exact_quantiles(logged, feature_columns(features, key))
    return logged.select(
        key, *[((F.col(c) - F.lit(m)) / F.lit(hi - lo if hi > lo else 1.0)).alias(c) for c, (lo, m, hi) in quartiles.items()]
    )


def scaled_vectors(features: DataFrame, key: str = "user_id") -> DataFrame:
    """``key, scaled``: the scaled features as one array per user, written once, as every pass of a fit reads it."""
    names = feature_columns(features, key)
    scaled = robust_scaled(features, key).select(key, F.array(*[F.col(n).cast("double") for n in names]).alias("scaled"))
    return materialize(scaled, "scaled")


class Mixture(NamedTuple):
    """A Gaussian mixture with full covariances, and its log-likelihood on the rows it was fitted to."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    log_likelihood: float = -math.inf

    @property
    def k(self) -> int:
        return len(self.weights)

    def densities(self) -> np.ndarray:
        """A row per component: its log of weight times density as a linear function of ``_terms``."""
        d = self.means.shape[1]
        upper = np.triu_indices(d)
        out = []
        for w, m, c in zip(self.weights, self.means, self.covariances, strict=True):
            inverse = np.linalg.inv(c)
            constant = math.log(w) - 0.5 * (d * math.log(2 * math.pi) + np.linalg.slogdet(c)[1] + m @ inverse @ m)
            squares = np.where(upper[0] == upper[1], -0.5, -1.0) * inverse[upper]
            out.append(np.concatenate([[constant], inverse @ m, squares]))
        return np.array(out)

    def updated(self, sums: np.ndarray, log_likelihood: float, rows: int) -> Mixture:
        """The next mixture from the responsibilities' sums of ``_terms``; an empty component stays as it is."""
        d = self.means.shape[1]
        upper = np.triu_indices(d)
        held = sums[:, 0] > 1e-8 * rows
        count = np.maximum(sums[:, :1], 1e-300)
        means = np.where(held[:, None], sums[:, 1 : d + 1] / count, self.means)
        squares = np.zeros((len(sums), d, d))
        squares[:, upper[0], upper[1]] = squares[:, upper[1], upper[0]] = sums[:, d + 1 :] / count
        spread = squares - means[:, :, None] * means[:, None, :] + FLOOR * np.eye(d)
        covariances = np.where(held[:, None, None], spread, self.covariances)
        weights = np.maximum(sums[:, 0] / rows, 1e-12)
        return Mixture(weights / weights.sum(), means, covariances, log_likelihood)


def _terms(x: np.ndarray) -> np.ndarray:
    """1, every value, every product of two values of each row: a mixture's densities and sums are linear in these."""
    i, j = np.triu_indices(x.shape[1])
    return np.concatenate([np.ones((len(x), 1)), x, x[:, i] * x[:, j]], axis=1)


def _rows_of(batch: pa.RecordBatch, column: str = "scaled") -> np.ndarray:
    return batch[column].flatten().to_numpy().reshape(batch.num_rows, -1)


_SUMS = "k int, sums array<double>, log_likelihood double"


def _expectations(vectors: DataFrame, models: dict[int, Mixture]) -> dict[int, tuple[np.ndarray, float]]:
    """By k: the sums of ``_terms`` weighted by each component's share of a row, and the log-likelihood.

    One pass serves all models. Tasks send a row per model, and these are added up on the executors, so the driver gets
    one row per model whatever the number of tasks.
    """
    densities = {k: m.densities() for k, m in models.items()}
    cuts = np.cumsum([0, *(len(w) for w in densities.values())])
    stacked = np.concatenate(list(densities.values()))

    def sent(sums: dict[int, list]) -> pa.RecordBatch:
        columns = [pa.array(sums, pa.int32()), pa.array([s[0].ravel() for s in sums.values()], pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays([*columns, pa.array([s[1] for s in sums.values()], pa.float64())], ["k", "sums", "log_likelihood"])

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {k: [np.zeros_like(w), 0.0] for k, w in densities.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            terms = _terms(_rows_of(batch))
            logs = terms @ stacked.T
            for i, own in enumerate(sums.values()):
                part = logs[:, cuts[i] : cuts[i + 1]]
                top = part.max(1, keepdims=True)
                share = np.exp(part - top)
                total = share.sum(1, keepdims=True)
                own[0] += (share / total).T @ terms
                own[1] += float((top + np.log(total)).sum())
        yield sent(sums)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for k, part, value in zip(*(batch[c].to_pylist() for c in ("k", "sums", "log_likelihood")), strict=True):
                own = sums.setdefault(k, [np.zeros(len(part)), 0.0])
                own[0] += part
                own[1] += value
        yield sent(sums)

    partial = vectors.select("scaled").mapInArrow(shares, _SUMS).repartition(len(models), "k").mapInArrow(added, _SUMS)
    return {r["k"]: (np.array(r["sums"]).reshape(densities[r["k"]].shape), r["log_likelihood"]) for r in partial.collect()}


def _start(sample: np.ndarray, k: int) -> Mixture:
    """A first mixture from a bounded sample: spread-out centers, a few rounds of nearest means."""
    rng = np.random.default_rng(SEED + k)
    centers = [sample[0]]
    nearest = ((sample - centers[0]) ** 2).sum(1)
    while len(centers) < k:
        chance = nearest / nearest.sum() if nearest.sum() > 0 else np.full(len(sample), 1 / len(sample))
        centers.append(sample[rng.choice(len(sample), p=chance)])
        nearest = np.minimum(nearest, ((sample - centers[-1]) ** 2).sum(1))
    means = np.array(centers)
    for _ in range(START_ROUNDS):
        own = ((sample[:, None, :] - means) ** 2).sum(2).argmin(1)
        means = np.array([sample[own == i].mean(0) if (own == i).any() else means[i] for i in range(k)])
    d = sample.shape[1]
    whole = np.cov(sample.T, bias=True).reshape(d, d) if len(sample) > 1 else np.eye(d)
    spreads = [np.cov(sample[own == i].T, bias=True).reshape(d, d) if (own == i).sum() > 2 * d else whole for i in range(k)]
    counts = np.bincount(own, minlength=k) + 1.0
    return Mixture(counts / counts.sum(), means, np.array(spreads) + FLOOR * np.eye(d))


def fit_mixtures(vectors: DataFrame, ks: Sequence[int], key: str = "user_id") -> dict[int, Mixture]:
    """A mixture for each k, all fitted in the same passes (expectation maximisation).

    The start is drawn from ``START_USERS`` users chosen by a hash of their key, so the fit does not depend on how the rows
    are partitioned. A model is done when its mean log-likelihood gains less than ``TOLERANCE``; the passes go on with
    the others.
    """
    sample = np.array([r["scaled"] for r in vectors.orderBy(F.xxhash64(key), key).limit(START_USERS).collect()])
    rows = vectors.count()
    models, done = {k: _start(sample, k) for k in ks}, {}
    held = vectors.persist()
    try:
        for _ in range(MAX_ITERATIONS):
            for k, (sums, likelihood) in _expectations(held, models).items():
                old = models[k]
                if abs(likelihood - old.log_likelihood) < TOLERANCE * rows:
                    done[k] = models.pop(k)._replace(log_likelihood=likelihood)
                else:
                    models[k] = old.updated(sums, likelihood, rows)
            if not models:
                break
        # What has not settled gets the likelihood of its last mixture.
        for k, (_, likelihood) in (_expectations(held, models) if models else {}).items():
            done[k] = models[k]._replace(log_likelihood=likelihood)
    finally:
        held.unpersist()
    return done


def labels(vectors: DataFrame, model: Mixture, key: str = "user_id") -> DataFrame:
    """``key, classification``: the likeliest component of each user."""
    densities = model.densities()

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = (_terms(_rows_of(batch)) @ densities.T).argmax(1) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch[key], pa.array(label.astype(np.int32))], [key, "classification"])

    return vectors.select(key, "scaled").mapInArrow(best, f"{key} {vectors.schema[key].dataType.simpleString()}, classification int")


def aic(log_likelihood: float, k: int, dims: int) -> float:
    """Akaike criterion of a full-covariance mixture."""
    free = k * dims + k * dims * (dims + 1) / 2 + (k - 1)
    return 2.0 * free - 2.0 * log_likelihood


def search_mixtures(
    vectors: DataFrame, min_k: int = MIN_K, max_k: int = MAX_K, key: str = "user_id"
) -> tuple[DataFrame, dict[int, Mixture]]:
    """``k, aic`` for every k of the range, and the fitted models by k."""
    models = fit_mixtures(vectors, range(min_k, max_k + 1), key)
    scores = [(k, aic(m.log_likelihood, k, m.means.shape[1])) for k, m in sorted(models.items())]
    return vectors.sparkSession.createDataFrame(scores, "k int, aic double"), models


def aic_scores(vectors: DataFrame, min_k: int = MIN_K, max_k: int = MAX_K, key: str = "user_id") -> DataFrame:
    return search_mixtures(vectors, min_k, max_k, key)[0]


def elbow(scores: DataFrame) -> DataFrame:
    """The k with the largest second difference of AIC; ties go to the smallest k.

    The first and last k have no second difference and cannot be chosen. The
    window runs over one row per k.
    """
    w = Window.orderBy("k")
    bend = F.lead("aic").over(w) - 2 * F.col("aic") + F.lag("aic").over(w)
    return (
        scores.withColumn("second_difference", bend)
        .where(F.col("second_difference").isNotNull())
        .orderBy(F.col("second_difference").desc(), "k")
        .limit(1)
        .select("k", "second_difference")
    )


def cluster_users(vectors: DataFrame, features: DataFrame, k: int, key: str = "user_id", model: Mixture | None = None) -> DataFrame:
    """Raw features with the cluster of each user; fits unless the model of a search is given."""
    model = model or fit_mixtures(vectors, [k], key)[k]
    return features.join(labels(vectors, model, key), key)


def cluster_summary(labelled: DataFrame, key: str = "user_id", label: str = "classification") -> DataFrame:
    """Mean of every raw feature per cluster."""
    names = [c for c in labelled.columns if c not in (key, label)]
    return labelled.groupBy(label).agg(
        F.count(F.lit(1)).alias("members"), *[F.avg(c).alias(f"avg_{c}") for c in names]
    )


def waterfall(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """The first rule that holds names the tag, so every cluster gets exactly one."""
    tag = F.lit(default)
    for condition, name in reversed(rules):
        tag = F.when(condition, F.lit(name)).otherwise(tag)
    return tag


def name_clusters(
    summary: DataFrame,
    status_rules: Sequence[tuple[Column, str]] | None = None,
    plan_rules: Sequence[tuple[Column, str]] | None = None,
    feature_rules: Sequence[tuple[Column, str]] | None = None,
) -> DataFrame:
    """Three tags per cluster. The thresholds are defaults of ours; pass your own."""
    status_rules = status_rules or [
        (F.col("avg_recency") <= 120, "active"),
        (F.col("avg_recency") <= 365, "at_risk"),
    ]
    plan_rules = plan_rules or [
        (F.col("avg_frequency") >= 10, "subscription"),
        (F.col("avg_frequency") >= 4, "swing"),
    ]
    feature_rules = feature_rules or [
        (F.col("avg_monetary") >= 2_500_000, "vvip"),
        (F.col("avg_tenure") <= 180, "newcomer"),
    ]
    return summary.select(
        "classification",
        waterfall(status_rules, "dormant").alias("cluster 1"),
        waterfall(plan_rules, "pay_per_use").alias("cluster 2"),
        waterfall(feature_rules, "regular").alias("cluster 3"),
    )


def with_names(labelled: DataFrame, key: str = "user_id") -> DataFrame:
    """Labelled users with the names of their clusters.

    There is one row of names per cluster, a proven bound, so the large side is not shuffled.
    """
    names = F.broadcast(name_clusters(cluster_summary(labelled, key)))
    return labelled.join(names, "classification", "left")


def segment_users(
    features: DataFrame,
    k: int | None = None,
    min_k: int = MIN_K,
    max_k: int = MAX_K,
    key: str = "user_id",
) -> DataFrame:
    """Scale, choose k unless given, fit, summarize, name, and join the names back.

    The features are read by several passes, so they are written first.
    """
    features = materialize(features, "features")
    if features.isEmpty():
        raise ValueError("no feature rows for this date")
    vectors = scaled_vectors(features, key)
    model = None
    if k is None:
        scores, models = search_mixtures(vectors, min_k, max_k, key)
        k = elbow(scores).first()["k"]
        model = models[k]
    labelled = materialize(cluster_users(vectors, features, k, key, model), "labelled")
    return with_names(labelled, key)
