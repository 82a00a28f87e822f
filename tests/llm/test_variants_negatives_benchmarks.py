"""Spelling variants, hard negatives and benchmark search against brute force, with edge cases."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from compare import difference, duck

from tidemark.llm import decontamination, hard_negatives, spelling
from tidemark.llm.oracle import ORACLE_SQL
from tidemark.llm.wordlists import word_lists

DOCS = "doc_id bigint, text string"
LONG = 2_000_000


def letters(rng, n, alphabet="abcdeé"):
    return "".join(rng.choice(alphabet) for _ in range(n))


# spelling variants


def one_edit(a, b):
    """Whether exactly one inserted, deleted or replaced code point separates two words."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows, slip_every=spelling.SLIP_EVERY):
    n = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            n[run if h % slip_every else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def variants(n):
    out = {}
    for w in n:
        near = [x for x in n if one_edit(w, x)]
        best = min(near, key=lambda x: (-n[x], x), default=None)
        out[w] = [n[w], len(near)] + ([best, n[best]] if near and n[best] >= 10 * n[w] else [None, None])
    for row in list(out.values()):
        root = row[2]
        while root and out[root][2]:
            root = out[root][2]
        row.append(root)
    return {(w, *r[:4], r[4] or w) for w, r in out.items()}


def test_variants_equal_brute_force(spark):
    rng = random.Random(2)
    base = [letters(rng, rng.randrange(6, 13)) for _ in range(60)] + ["aaaaaaa", "aaaaaaaa", "abababab", "Aaaaaaab"]
    rows = []
    for doc in range(40):
        words = []
        for _ in range(300):
            w = base[min(int(rng.expovariate(0.1)), len(base) - 1)]
            if rng.random() < 0.2:
                i, kind = rng.randrange(len(w)), rng.randrange(3)
                w = w[:i] + (letters(rng, 1) if kind else "") + w[i + (kind != 1) :]
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((doc, rng.choice([" ", "-", "中", "1"]).join(words)))
    rows += [(None, "Nullnull nullnull nullnull"), (None, "nullnull"), (7, None), (8, ""), (9, "×" * 9 + " " + "×" * 9)]
    got = spelling.spelling_variants(spelling.word_counts(spark.createDataFrame(rows, DOCS)))
    expected = variants(counted(rows))
    assert {tuple(r) for r in got.collect()} == expected
    assert sum(r[2] > 0 for r in expected) > 100 and any(r[3] and r[5] != r[3] for r in expected)


def test_counts_hold_in_slices(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, " ".join(letters(rng, 8, "ab") for _ in range(200))) for i in range(5)]
    monkeypatch.setattr(spelling, "HELD_BYTES", 300)
    whole = {tuple(r) for r in spelling.word_counts(spark.createDataFrame(rows, DOCS)).collect()}
    assert whole == set(counted(rows).items())
    pieces = [w for words in word_lists(b"one two  three four", spelling.WORD_BYTES, piece=2) for w in words]
    assert pieces == [b"one", b"two", b"three", b"four"]


def test_variants_of_long_and_missing_texts(spark):
    long_word = "ab" * 20_000
    rows = [(1, " " * LONG), (2, "\n" * LONG), (3, "a" * LONG), (4, "a" * LONG), (5, f"{long_word} {long_word} {long_word}x {long_word}x")]
    docs = spark.createDataFrame(rows, DOCS)
    got = spelling.spelling_variants(spelling.word_counts(docs, slip_every=1 << 40)).collect()
    assert {(len(r["word"]), r["n"], r["n_near"]) for r in got} == {(LONG, 2, 0), (40_000, 2, 1), (40_001, 2, 1)}
    assert spelling.spelling_variants(spelling.word_counts(docs.limit(0))).isEmpty()
    clash = docs.selectExpr("doc_id", "text", "1 as word", "2 as n", "3 as key").limit(0)
    assert spelling.spelling_variants(spelling.word_counts(clash)).columns == ["word", "n", "n_near", "form", "form_n", "root"]


# hard negatives


VECTORS = "vec_id bigint, embedding array<double>, label int"


def mined(rows, step=100):
    """Brute force over (id, integers, label)."""
    out = set()
    for i, v, label in rows:
        if i % step:
            continue
        scored = sorted(((-sum(int(a) * int(b) for a, b in zip(v, w, strict=True)), j, other) for j, w, other in rows if j != i))
        for minus, p, _ in [s for s in scored if s[2] == label][:5]:
            fits = [(j, -m) for m, j, other in scored if other != label and 80 * -minus <= 100 * -m <= 100 * -minus][:5]
            out |= {(i, p, rank, j, -minus, s) for rank, (j, s) in enumerate(fits, 1)}
    return out


def test_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(6, 8))
    rows = []
    for i in range(1500):
        v = centers[i % 6] + rng.normal(size=8) * 0.3
        rows.append((i, [float(x) for x in v], int(rng.integers(0, 4))))
    rows += [(2000 + i, rows[100][1], i % 3) for i in range(300)]  # a group of copies
    rows += [(3000, [0.0] * 8, 1), (3100, [-1.0] * 8, 1), (3200, [1e-9] * 8, 2)]
    got = hard_negatives.hard_negatives(hard_negatives.usable(spark.createDataFrame(rows, VECTORS)))
    expected = mined([(i, [int(np.floor(256 * x)) for x in v], label) for i, v, label in rows])
    assert {tuple(r) for r in got.collect()} == expected and len(expected) > 200


def test_several_blocks_of_anchors_agree(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=4)], int(i % 3)) for i in range(400)]
    ready = hard_negatives.usable(spark.createDataFrame(rows, VECTORS))
    whole = {tuple(r) for r in hard_negatives.hard_negatives(ready, anchor_step=10).collect()}
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 5000)
    assert {tuple(r) for r in hard_negatives.hard_negatives(ready, anchor_step=10).collect()} == whole
    assert whole == mined([(i, [int(np.floor(256 * x)) for x in v], label) for i, v, label in rows], 10)


@pytest.mark.parametrize("size", [40, 1e6, 1e8, 3e9])
def test_scores_of_any_size_equal_brute_force(size):
    """Floats of 32 and 64 bits, integers of 64, longer ones; in batches, with ties, all close and far apart."""
    rng = np.random.default_rng(int(size))
    n, dim = 1300, 4
    v = (np.abs(rng.normal(size=(n, dim))) * size).astype(np.int64)
    v[200:500] = v[7]
    v[500:600] *= -1
    ids, labels = rng.permutation(n).astype(np.int64), rng.integers(0, 3, n)
    refs = np.eye(dim)[:2]
    lengths = np.sqrt((v.astype(float) ** 2).sum(1))
    angles = np.arccos(np.clip(v.astype(float) @ refs.T / np.maximum(lengths, 1e-300)[:, None], -1, 1))
    cut = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))

    def found(chosen, highs=None):
        columns = {"id": ids[chosen], "label": labels[chosen], "v": v[chosen].tolist(), "length": lengths[chosen], "angles": angles[chosen].tolist()}
        held = hard_negatives.Anchors(pa.table(columns | ({"high": pa.array(highs, pa.list_(pa.int64()))} if highs else {})), dim, 5)
        for at in range(0, n, 500):
            part = slice(at, at + 500)
            held.meet(ids[part], labels[part], v[part], lengths[part], angles[part])
        out = {}
        for r in sorted(held.found().to_pylist(), key=lambda r: (-r["score"], r["vec_id"])):
            out.setdefault((r["anchor_id"], r["slot"]), []).append((r["score"], r["vec_id"]))
        return out

    chosen = np.flatnonzero(ids % 25 == 0)
    scored = {a: [(cut(sum(int(x) * int(y) for x, y in zip(v[a], w, strict=True))), int(j), o) for j, w, o in zip(ids, v, labels, strict=True) if j != ids[a]] for a in chosen}
    best = lambda rows: sorted(rows, key=lambda r: (-r[0], r[1]))[:5]
    positives = {a: best([(s, j) for s, j, o in scored[a] if o == labels[a]]) for a in chosen}
    assert found(chosen) == {(int(ids[a]), 0): p for a, p in positives.items()}
    highs = [[s for s, _ in positives[a]][: 5 - a % 2] for a in chosen]
    windows = {
        (int(ids[a]), i): fits
        for a, own in zip(chosen, highs, strict=True)
        for i, high in enumerate(own)
        if (fits := best([(s, j) for s, j, o in scored[a] if o != labels[a] and 80 * high <= 100 * s <= 100 * high]))
    }
    assert found(chosen, highs) == windows and len(windows) > 50


def test_no_bounds_for_single_vectors_where_floats_are_exact(monkeypatch):
    """Only cells are bounded, once for a batch, and a merge reads the slots it changes alone."""
    rng = np.random.default_rng(4)
    x = rng.integers(-200, 200, size=(1000, 8))
    lengths = np.sqrt((x.astype(float) ** 2).sum(1))
    angles = np.arccos(np.clip(x @ np.eye(8)[:3].T / lengths[:, None], -1, 1))
    columns = {"id": np.arange(1000), "label": np.zeros(1000, np.int64), "v": x.tolist(), "length": lengths, "angles": angles.tolist()}
    held, bounded, bounds = hard_negatives.Anchors(pa.table(columns), 8, 5), [], hard_negatives.score_bounds
    monkeypatch.setattr(hard_negatives, "score_bounds", lambda a, b, c, d: bounded.append(len(a) * len(c[0])) or bounds(a, b, c, d))
    held.meet(columns["id"], columns["label"], x, lengths, angles)
    assert sum(bounded) == 1000 * -(-1000 // hard_negatives.CELL)
    score = x @ x.T
    for i in range(0, 1000, 97):
        order = sorted((-s, j) for j, s in enumerate(score[i]) if j != i)[:5]
        assert [(r["score"], r["vec_id"]) for r in held.found().to_pylist() if r["anchor_id"] == i] == [(-s, j) for s, j in order]
    merged = []
    real = np.lexsort
    monkeypatch.setattr(hard_negatives.np, "lexsort", lambda keys: merged.append(len(keys[0])) or real(keys))
    held.best.add(np.array([3]), np.array([1 << 40]), np.array([-1]))
    assert merged == [6] and held.best.score[3, 0] == 1 << 40


def test_bounds_hold():
    rng = np.random.default_rng(3)
    refs = np.linalg.qr(rng.normal(size=(6, 6)))[0][:3]
    x = rng.integers(-300, 300, size=(200, 6)).astype(float)
    x[::7] = x[0]  # equal vectors, angle 0
    x[::11] = -x[0]
    lengths = np.sqrt((x**2).sum(1))
    angles = np.arccos(np.clip(x @ refs.T / lengths[:, None], -1, 1))
    least, most = hard_negatives.score_bounds(lengths, angles, (lengths, lengths), (angles, angles))
    assert (least <= x @ x.T).all() and (x @ x.T <= most).all()
    lows, highs = (f(a, axis=0, keepdims=True) for a in (lengths,) for f in (np.min, np.max))
    low_angles, high_angles = angles.min(0, keepdims=True), angles.max(0, keepdims=True)
    least, most = hard_negatives.score_bounds(lengths, angles, (lows, highs), (low_angles, high_angles))
    assert (least <= (x @ x.T).min(1, keepdims=True)).all() and ((x @ x.T).max(1, keepdims=True) <= most).all()


def test_negatives_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.9, 0.1], 2), (3, [0.9], 2), (None, [1.0, 0.0], 2),
        (4, None, 2), (5, [None, 1.0], 2), (6, [nan, 1.0], 2), (7, [inf, 1.0], 2), (8, [1.0, 0.0], None), (9, [], 2), (100, [0.0, 0.0], 1), (200, [5e8, 5e8], 3),
    ]
    frame = spark.createDataFrame(rows, VECTORS)
    got = {tuple(r) for r in hard_negatives.hard_negatives(hard_negatives.usable(frame)).collect()}
    ready = [(0, (256, 0), 1), (1, (256, 0), 1), (2, (230, 25), 2), (3, (230, 0), 2), (9, (0, 0), 2), (100, (0, 0), 1), (200, (5 * 256 * 10**8,) * 2, 3)]
    assert got == mined(ready)
    assert hard_negatives.hard_negatives(hard_negatives.usable(frame.limit(0))).isEmpty()
    clash = frame.selectExpr("*", "1 as id", "2 as v", "3 as r", "4 as length")
    assert {tuple(r) for r in hard_negatives.hard_negatives(hard_negatives.usable(clash)).collect()} == got


# benchmark search


def words_of(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def found(docs, items, width=10):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words_of(text)
        if item is not None and w:
            for i in range(max(1, len(w) - width + 1)):
                windows[tuple(w[i : i + width])].add(str(item))
    out = []
    for doc, text in docs:
        w, hit, own = words_of(text), set(), set()
        for m in {len(p) for p in windows}:
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in windows:
                    hit |= {*range(i, i + m)}
                    own |= windows[tuple(w[i : i + m])]
        out.append((doc, len(w), tuple(sorted(hit)), tuple(sorted(own))))
    return collections.Counter(out)


def rows_of(frame):
    return collections.Counter(
        (r["doc_id"], r["n_words"], tuple(j for s in r["spans"] for j in range(s["first"], s["last"] + 1)), tuple(r["items"])) for r in frame.collect()
    )


@pytest.fixture(scope="module")
def leaks():
    rng = random.Random(8)
    vocab = [letters(rng, rng.randrange(1, 4), "abé") for _ in range(12)]  # few words, so that blocks recur
    items = [(i, " ".join(rng.choices(vocab, k=rng.randrange(1, 40)))) for i in range(30)]
    items += [(40, items[3][1]), (41, items[3][1].upper()), (None, "a b c"), (42, None), (43, ""), (44, "?!"), (45, "solo")]
    docs = []
    for doc in range(60):
        words = rng.choices(vocab, k=rng.randrange(0, 80)) + words_of(rng.choice(items)[1]) + rng.choices(vocab, k=5)
        docs.append((doc, rng.choice([" ", ", ", "_"]).join(words)))
    docs += [(70, None), (71, ""), (None, items[0][1]), (None, items[0][1]), (72, "Solo"), (73, "solos")]
    return docs, items


def test_search_equals_brute_force(spark, leaks, monkeypatch):
    docs, items = leaks
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id bigint, text string")
    expected = found(docs, items)
    assert rows_of(decontamination.benchmark_hits(*frames)) == expected
    assert rows_of(decontamination.benchmark_hits(*frames, block_bytes=200)) == expected  # many blocks
    digests = decontamination.contamination(decontamination.benchmark_hits(*frames)).where("doc_id = 70").first()
    assert tuple(digests)[1:4] == (0, 0, 0) and not digests["contaminated"]
    empty = decontamination.benchmark_hits(frames[0], frames[1].limit(0))
    assert rows_of(empty) == found(docs, [])
    assert decontamination.benchmark_hits(frames[0].limit(0), frames[1]).isEmpty()


def test_windows_across_pieces(leaks):
    docs, items = leaks
    rows = [(str(i), [w.encode() for w in words_of(t)]) for i, t in items if words_of(t)]
    patterns = decontamination.Patterns(rows, 10)
    for _, text in docs:
        data = (text or "").encode()
        whole = patterns.hits(word_lists(data, decontamination.WORD_BYTES))
        assert patterns.hits(word_lists(data, decontamination.WORD_BYTES, piece=7)) == whole


def test_segments_hold_every_window_once():
    rng = random.Random(1)
    for n in (1, 9, 10, 11, 57, 400):
        words = [str(i).encode() for i in range(n)]
        cut = list(decontamination.segments(iter([words[: n // 2], words[n // 2 :]]), 10, size=rng.choice([5, 40, 300])))
        got = [tuple(s[i : i + min(10, len(s))]) for s in cut for i in range(max(1, len(s) - 9))]
        assert got == [tuple(words[i : i + 10]) for i in range(max(1, n - 9))]


def test_search_in_long_texts(spark):
    rows = [(1, " " * LONG), (2, "\n" * LONG), (3, "a" * LONG), (4, "x " * (LONG // 2) + "one two three four five six seven eight nine ten")]
    items = spark.createDataFrame([(1, "One two three, four five six seven eight nine ten."), (2, "a" * LONG)], "item_id bigint, text string")
    got = decontamination.contamination(decontamination.benchmark_hits(spark.createDataFrame(rows, DOCS), items))
    assert {tuple(r)[:4] for r in got.collect()} == {(1, 0, 0, 0), (2, 0, 0, 0), (3, 1, 1, 1), (4, LONG // 2 + 10, 10, 1)}


def test_search_ignores_other_columns(spark, leaks):
    docs, items = leaks
    frame = spark.createDataFrame(docs, DOCS).selectExpr("*", "'x' as item", "1 as n_words", "2 as doc_key", "3 as spans")
    clash = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'y' as words", "1 as item", "2 as block")
    assert rows_of(decontamination.benchmark_hits(frame, clash)) == found(docs, items)


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_angular_negatives", "op13_wu_manber"])
def test_equals_sql_on_more_rows(spark, name):
    from tidemark.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    assert difference(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLE_SQL[name]) is None
