"""Corpus operators against brute force, round trips and held-out accuracy, with edge cases."""

import collections
import hashlib
import os
import random
import re
import time
import tracemalloc
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from compare import difference, duck
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import bpe, hashing, line_frequency, packing, parity_join, quality, sentence_spans, small_world, suffixes, top_products, warc
from tidemark.llm.components import components
from tidemark.llm.oracle import ORACLE_SQL
from tidemark.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD_FILE, BYTE_FILE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
HARD = [
    "", " ", "a  b", " a b", "a \nb c", "it's  we'LL don't 's", "日本 語 🎉 👍🏽", "a<|endoftext|> b <|startoftext|>", "\x1c a \x85 b x\x1cy",
    "tabs\t x \t", "end ", "\x00\x01", "a" * 3000, "é ́e ½ ² Ⅷ 1٣", "ΟΔΟΣ ΣΑΣ İstanbul ﬁ", "x" * 50_000 + " " + "word " * 5_000,
]


def prose(rng, n, size=300):
    return " ".join(f"w{rng.randrange(size)}" + (". " if rng.random() < 0.1 else "").strip() for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """Documents with copies, near copies, shared passages, nulls, empty texts and one very long text."""
    rng = random.Random(3)
    base = [prose(rng, rng.randrange(1, 400), 5000) for _ in range(60)]
    passage = prose(rng, 60, 5000)
    out = base + base[:5] + [base[7]] * 8
    for i in range(25):
        words = base[i].split()
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(len(words))] = f"x{i}"
        out.append(" ".join(words))
    out += [prose(rng, 30, 5000) + "\n" + passage + "\n" + prose(rng, 20, 5000) for _ in range(6)]
    out += [None, "", " \n ", "one", "one", "two words", "ab" * 400, "Ab" * 400, prose(rng, 20_000, 20_000)]
    return out


@pytest.fixture(scope="module")
def documents(spark, texts):
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def awkward(spark):
    """Null ids, sources and texts, a repeated row, an id with two texts, and columns named like helpers."""
    text = prose(random.Random(9), 80)
    rows = [(None, text, None), (None, None, "s"), (1, text, "s"), (1, text, "s"), (2, "other words here", "s"), (2, text + " end", "s"), (3, "", None)]
    names = "row", "page", "id", "kept", "n", "firsts", "key", "host"
    schema = "doc_id bigint, text string, source string, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([r + ("z",) * len(names) for r in rows], schema)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLE_SQL[name]) is None


# quality


def test_quality_separates_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    scored = QUERIES["op1_pu_quality"](spark, sf_dir).join(labels, "doc_id").where("held_out").toPandas()
    assert (scored["predicted"] == scored["quality"]).mean() > 0.95
    expected = {i for i in range(1000) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert set(QUERIES["op1_pu_quality"](spark, sf_dir).where("held_out").toPandas()["doc_id"]) == expected
    assert docs.count() == QUERIES["op1_pu_quality"](spark, sf_dir).count()


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1), (None, 1), (1, 0), (2, 1)], "doc_id bigint, quality int")
    model = quality.fit(awkward(spark), labels)
    assert quality.score(awkward(spark), model).count() == 7
    assert quality.keep_good(awkward(spark), model).columns == awkward(spark).columns
    none = quality.fit(empty(spark), labels.limit(0))
    assert {r["score"] for r in quality.score(awkward(spark), none).collect()} == {0.5}
    assert quality.score(empty(spark), none).isEmpty()


def test_gradients_by_finite_differences():
    rng = np.random.default_rng(2)
    w = [rng.normal(size=(5, 4)), rng.normal(size=4), rng.normal(size=4), np.array(0.3)]
    x, pull = rng.normal(size=(30, 5)), rng.normal(size=30)
    grads = quality._backward(w, x, quality._forward(w, x)[0], pull)
    for a, g in zip(w, grads, strict=True):
        for at in np.ndindex(a.shape):
            kept, sides = a[at].copy(), []
            for step in (1e-5, -1e-5):
                a[at] = kept + step
                sides.append(float(quality._forward(w, x)[1] @ pull))
            a[at] = kept
            assert (sides[0] - sides[1]) / 2e-5 == pytest.approx(float(g[at]), rel=1e-5, abs=1e-7)


def test_prior_is_the_least_ratio():
    rng = np.random.default_rng(4)
    positive, unlabelled = rng.normal(1, 1, 150), rng.normal(0, 1, 400)
    slack = np.sqrt(np.log(20) / 2) * (400**-0.5 + 150**-0.5)
    found = []
    for t in positive:
        share, above = np.mean(positive >= t), np.mean(unlabelled >= t)
        found.append(((above + slack) / share, above / share))
    assert quality.best_bin_prior(positive, unlabelled) == pytest.approx(min(found)[1])


def test_prior_is_found():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(3, 1, (4000, 50)), rng.normal(-3, 1, (1200, 50))
    assert abs(quality.best_bin_prior(good[:2000, 0], np.concatenate([good[2000:, 0], bad[:, 0]])) - 2000 / 3200) < 0.05


# packing


def test_piece_ids_are_the_librarys(texts):
    library, own = Tokenizer.from_file(BYTE_FILE), packing.PieceTokenizer(BYTE_FILE)
    for text in HARD + [t for t in texts if t]:
        assert own.encode(text) == array("I", library.encode(text, add_special_tokens=False).ids).tobytes()


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 1_000_000 + "x", "a <|endoftext|>" + "\t " * 600_000 + "<|endoftext|> b"])
def test_piece_ids_of_long_white_space(spark, text):
    expected = Tokenizer.from_file(BYTE_FILE).encode(text, add_special_tokens=False).ids
    assert packing.PieceTokenizer(BYTE_FILE).encode(text) == array("I", expected).tobytes()
    frame = spark.createDataFrame([(1, text), (2, "short")], "doc_id bigint, text string")
    packed = packing.pack_documents(frame, BYTE_FILE).toPandas()
    assert packed.loc[packed["doc_id"] == 1, "length"].sum() == len(expected) + 1
    assert packed.groupby("sequence_id")["length"].sum().max() <= 1024


def test_fullest_is_the_best_sum():
    rng = random.Random(5)
    for _ in range(200):
        counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(5)}
        room, sums = rng.randrange(1, 60), {0}
        for length, n in counts.items():
            sums = {s + k * length for s in sums for k in range(n + 1)}
        used = packing.fullest(sorted(counts.items(), reverse=True), room)
        assert sum(k * n for k, n in used.items()) == max(s for s in sums if s <= room)
        assert all(n <= counts[k] for k, n in used.items())


def test_packing_places_every_piece(spark, documents, texts):
    rows = packing.pack_documents(documents, BYTE_FILE).toPandas()
    library, by_doc = Tokenizer.from_file(BYTE_FILE), {}
    for i, t in enumerate(texts):
        by_doc[i] = [*library.encode(t or "", add_special_tokens=False).ids, 2]
    for doc, part in rows.sort_values(["doc_id", "piece"]).groupby("doc_id"):
        ids, at = by_doc[doc], 0
        assert list(part["piece"]) == list(range(len(part)))
        for r in part.itertuples():
            assert r.start == at and (r.length == 1024 or r.piece == 0)
            assert r.ids_crc32 == zlib.crc32(array("I", ids[at : at + r.length]).tobytes())
            at += r.length
        assert at == len(ids)
    assert set(rows["doc_id"]) == set(by_doc)
    for _, part in rows.sort_values("offset").groupby("sequence_id"):
        ends = (part["offset"] + part["length"]).tolist()
        assert [0, *ends[:-1]] == part["offset"].tolist() and ends[-1] <= 1024
    bound = -(-rows["length"].sum() // 1024)
    assert rows["sequence_id"].nunique() <= 1.05 * bound
    with_ids = packing.sequences(packing.pack_documents(documents, BYTE_FILE, with_ids=True)).collect()
    assert sum(len(r["ids"]) for r in with_ids) == 4 * rows["length"].sum()


def test_packing_edges(spark):
    assert packing.pack_documents(empty(spark), BYTE_FILE).isEmpty()
    rows = packing.pack_documents(awkward(spark), BYTE_FILE).collect()
    assert len(rows) == 7 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 7


# inner products


def brute_top(vectors, k=10):
    good = {i: [int(np.floor(1024 * float(x))) for x in v] for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q in sorted(i for i in good if i % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(good[q], v, strict=False)), i) for i, v in good.items() if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)]
    return out


def test_top_products_with_ties_and_edges(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, (rng.normal(size=8) * rng.choice([0.1, 1, 30])).round(1).tolist()) for i in range(900)]
    vectors += [(1000, vectors[0][1]), (1001, None), (1002, [1.0, None] * 4), (1003, [float("nan")] * 8), (1100, [0.0] * 8), (1101, [1.0]), (None, [1.0] * 8)]
    frame = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>").selectExpr("*", "1 as id", "2 as v")
    got = sorted(tuple(r) for r in top_products.top_products(frame).collect())
    assert got == sorted(brute_top(vectors))
    assert top_products.top_products(frame.limit(0)).isEmpty()
    few = frame.where("vec_id in (100, 101)")
    assert [tuple(r)[:3] for r in top_products.top_products(few).collect()] == [(100, 1, 101)]


# suffixes


def brute_removed(rows, length=100):
    seen, out = {}, {}
    order = sorted(rows, key=lambda r: r[0])
    for doc, text in order:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if seen.setdefault(data[i : i + length], (doc, i)) < (doc, i):
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[doc] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def test_removed_bytes_equal_brute_force(spark, documents, texts):
    got = {r["doc_id"]: tuple(r)[1:5] for r in suffixes.removed_bytes(documents).collect()}
    assert got == brute_removed(list(enumerate(texts)))


def test_runs_split_and_merge_alike(spark, documents, texts, monkeypatch):
    monkeypatch.setattr(suffixes, "RUN", 50)
    monkeypatch.setattr(suffixes, "RANGE", 40)
    monkeypatch.setattr(suffixes, "SEGMENT", 700)
    got = {r["doc_id"]: tuple(r)[1:5] for r in suffixes.removed_bytes(documents).collect()}
    assert got == brute_removed(list(enumerate(texts)))


def test_suffixes_of_a_repetitive_text_come_in_slices():
    """A text with an anchor at every byte, in bounded memory, and the same repeats as in one piece."""
    data = np.frombuffer(b"ab" * 1_000_000 + b"end", np.uint8)
    keys = np.unique(suffixes.anchors(data[:5000])[3].view(np.int64))
    run, spans = suffixes._Run(np.zeros(0, np.uint64)), []
    tracemalloc.start()
    for _ in run.add(1, b"x" * 16, data, keys):
        spans += [row[4:] for row in run.sent() if row[1] is None]
        run.clear()
    assert tracemalloc.get_traced_memory()[1] < 500 << 20
    tracemalloc.stop()
    assert spans and all(b - a >= 100 for a, b in spans) and len(spans) < 100


def test_removed_bytes_edges(spark):
    assert suffixes.removed_bytes(empty(spark)).isEmpty()
    rows = suffixes.removed_bytes(awkward(spark)).collect()
    assert len(rows) == 7
    size = len(prose(random.Random(9), 80))
    assert [r["n_removed"] for r in rows if r["doc_id"] == 1] == [size] * 2
    assert sorted(r["n_removed"] for r in rows if r["doc_id"] is None) == [0, 0]


def test_loser_tree_gives_order_and_prefixes():
    rng, width = random.Random(2), 6
    for k in (0, 1, 2, 3, 5, 8):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(width)) for _ in range(rng.randrange(0, 9))) for _ in range(k)]
        coded = []
        for run in runs:
            rows = np.frombuffer(b"".join(run), np.uint8).reshape(-1, width)
            prefixes = suffixes.common_prefixes(rows)
            assert (suffixes.decoded(suffixes.front_coded(rows, prefixes), prefixes, width) == rows).all()
            coded.append(([int.from_bytes(x) for x in run], prefixes.tolist()))
        run, at, known = suffixes.merged(coded, width)
        merged = [runs[r][i] for r, i in zip(run, at, strict=True)]
        assert merged == sorted(x for r in runs for x in r)
        rows = np.frombuffer(b"".join(merged), np.uint8).reshape(-1, width)
        assert known == suffixes.common_prefixes(rows).tolist()


# archives


def pages_of(spark):
    rows = [(1, "http://www.a.org/x?q=1#f", "hello\r\n\r\nWARC/1.1 é"), (2, "https://b.a.org:8080/", "hello\r\n\r\nWARC/1.1 é"), (5, None, None), (4, "", ""),
            (7, "not a url\nat all", "x" * 100_000), (9, "http://a.org/x?q=1", "hello\r\n\r\nWARC/1.1 é"), (None, "http://n.org", ""), (9, "http://a.org/x?q=1", "hello\r\n\r\nWARC/1.1 é")]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as digest", "2 as file")


def test_archives_round_trip_and_look_ups(spark, tmp_path):
    archives, index = str(tmp_path / "warc"), str(tmp_path / "index")
    warc.write_archives(pages_of(spark), archives, file_bytes=50_000)
    warc.write_index(warc.read_records(spark, archives), index, block_lines=2)
    rows = {(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.read_index(spark, index).collect()}
    size = len("hello\r\n\r\nWARC/1.1 é".encode())
    assert rows == {(1, "revisit", 9, size), (2, "revisit", 9, size), (9, "response", None, size), (5, "response", None, 0), (4, "revisit", 5, 0), (None, "revisit", 5, 0), (7, "response", None, 100_000)}
    captures = warc.Captures(spark, index)
    lines = captures.lines("http://a.org/x?q=1")
    assert [x["page_id"] for x in lines] == [1, 9, 9]
    assert captures.payload(lines[-1]).decode() == "hello\r\n\r\nWARC/1.1 é"
    assert captures.lines("http://nowhere.org/") == []
    assert warc.url_key("https://user@www.Example.org:443/a?b#c") == "org,example)/a?b"


def test_many_look_ups_by_the_directory(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ROOT_BLOCKS", 2)
    rng = random.Random(6)
    urls = [f"http://h{rng.randrange(9)}.org/p{rng.randrange(30)}" for _ in range(120)] + ["http://hot.org/"] * 40
    lines = [(warc.url_key(u), i, "response", "d", None, i, "f", i, 1) for i, u in enumerate(urls)]
    frame = spark.createDataFrame(lines, warc._LINE)
    index = str(tmp_path / "index")
    warc.write_index(frame, index, block_lines=3)
    assert spark.read.parquet(f"{index}/directory").count() > 50
    asked = sorted(set(urls))[::2] + ["http://hot.org/", "http://nowhere.org/", "http://a.a/", "http://www.hot.org"]
    keys = warc.url_keys(spark.createDataFrame([(u,) for u in asked * 2] + [(None,)], "url string"))
    wanted = {warc.url_key(u) for u in asked}
    got = sorted((r["url_key"], r["page_id"]) for r in warc.find_captures(spark, index, keys).collect())
    assert got == sorted((k, i) for k, i, *_ in lines if k in wanted)
    blocks = warc.find_blocks(spark, index, keys).where(F.col("url_key") == warc.url_key("http://hot.org/")).count()
    assert blocks >= 13
    captures = warc.Captures(spark, index)
    assert [x["page_id"] for x in captures.lines("http://hot.org")] == list(range(120, 160))


def test_archives_of_no_pages(spark):
    assert warc.archive_round_trip(pages_of(spark).limit(0)).isEmpty()


# Jaccard join and components


def brute_components(rows, width, num, den):
    sets = {}
    for doc, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})))
        n = min(width, len(words))
        sets[doc] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    return {d: len(s) for d, s in sets.items()}, smallest(sets, links)


def smallest(nodes, links):
    of = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(of[a], of[b])
            if of[a] != low or of[b] != low:
                of[a] = of[b] = low
                changed = True
    return of


@pytest.mark.parametrize(("width", "num", "den"), [(3, 90, 100), (5, 8, 10)])
def test_jaccard_components(spark, documents, texts, width, num, den):
    sizes, of = brute_components(list(enumerate(texts)), width, num, den)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in parity_join.link_components(documents, width, num, den).collect()}
    assert got == {d: (sizes[d], of[d]) for d in sizes}
    kept = {r["doc_id"] for r in parity_join.keep_one(documents, width, num, den).collect()}
    assert kept == set(of.values())


def test_chains_of_near_copies_without_a_common_center(spark):
    rng = random.Random(8)
    words = [f"v{rng.randrange(9000)}" for _ in range(120)]
    rows = []
    for i in range(60):  # each changes two words of the one before: only neighbours link
        rows.append((i, " ".join(words)))
        for _ in range(2):
            words[rng.randrange(120)] = f"y{i}{rng.random()}"
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in parity_join.link_components(frame, 3, 85, 100).collect()}
    assert got == brute_components(rows, 3, 85, 100)[1]


@pytest.mark.parametrize("stars", [0, 2])
def test_links_between_copies_that_are_far_from_their_original(spark, monkeypatch, stars):
    monkeypatch.setattr(parity_join, "STAR_ROUNDS", stars)
    rng = random.Random(11)
    words, rows = [f"v{rng.randrange(9000)}" for _ in range(160)], []
    for i in range(70):  # further from the original than the limit, some close to each other, some only shorter
        own = list(words)
        for place in rng.sample(range(160), rng.randrange(3, 9)):
            own[place] = f"z{i}" if i % 3 else ""
        rows.append((i, " ".join(own)))
        if i % 4 == 0:
            own[rng.randrange(160)] = "last"
            rows.append((1000 - i, " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in parity_join.link_components(frame, 3, 90, 100).collect()}
    assert got == brute_components(rows, 3, 90, 100)[1]


@pytest.mark.parametrize("few", [2, 8])
def test_groups_of_copies_whose_originals_share_a_passage(spark, monkeypatch, few):
    """Buckets of several components: some groups are far apart, some near, some linked by a single pair of members."""
    monkeypatch.setattr(parity_join, "FEW", few)
    rng = random.Random(17)
    passage, rows = [f"p{i}" for i in range(60)], []
    for group in range(6):
        own = passage + [f"g{group}x{i}" for i in range(50)]
        if group in (3, 5):  # close to the group before: near misses, and links of some members
            own = list(before)
            for place in rng.sample(range(110), 5):
                own[place] = f"h{group}p{place}"
        before = list(own)
        for copy in range(14):
            words = list(own)
            for place in rng.sample(range(110), rng.randrange(0, 4)):
                words[place] = f"c{group}n{copy}p{place}"
            rows.append((rng.randrange(10**9), " ".join(words)))
    rows.append((rows[0][0], rows[20][1] + " and more"))  # an id with two texts
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for num in (80, 90):
        got = {r["doc_id"]: r["component_id"] for r in parity_join.link_components(frame, 3, num, 100).collect()}
        sets = [(i, {tuple(w[k : k + 3]) for k in range(len(w) - 2)}) for i, w in ((i, t.split()) for i, t in rows)]
        links = [(a, b) for a, x in sets for b, y in sets if a < b and 100 * len(x & y) >= num * len(x | y)]
        assert got == smallest(list({i for i, _ in rows}), links)
        assert 1 < len(set(got.values())) < 80


def test_far_copies_that_share_a_passage_meet_by_what_is_rare(spark):
    """Far from the center, but only copies of copies are near each other: a passage that all hold brings no pairs."""
    rng, new = random.Random(23), iter(range(10**6, 10**9))
    center, passage = list(range(200)), list(range(1000, 1030))
    sets = {0: center}
    for i in range(1, 300):
        if i % 10:
            sets[i] = rng.sample(center, 176) + passage + [next(new) for _ in range(28)]
        else:  # links with the one before
            sets[i] = rng.sample(sets[i - 1], 230) + [next(new) for _ in range(4)]
    hashed = {i: np.sort(hashing.mix(np.array(s, np.uint64))) for i, s in sets.items()}
    frame = spark.createDataFrame([(i, h.tobytes()) for i, h in hashed.items()], "id bigint, hashes binary")
    # The center is the one that is in all three buckets.
    buckets = [(1, i) for i in sets] + [(2, i) for i in range(20)] + [(3, i) for i in (0, *range(20, 40))]
    size = {1: 300, 2: 20, 3: 21}
    buckets = spark.createDataFrame([(k, size[k], i, i) for k, i in buckets], "key bigint, members bigint, id bigint, c bigint")
    got = {(r["a"], r["b"]) for r in parity_join._apart_pairs(buckets, frame, 80, 100).collect()}
    links = {(a, b) for a in sets for b in sets if a < b and 5 * len({*sets[a]} & {*sets[b]}) >= 4 * len({*sets[a]} | {*sets[b]})}
    assert links == {(i - 1, i) for i in range(10, 300, 10)}
    assert links <= got
    assert len(got) <= 299 + 2 * len(links)  # all meet the center


def test_sketches_differ_in_at_most_the_symmetric_difference():
    rng = np.random.default_rng(1)
    a = hashing.mix(rng.integers(0, 1 << 62, 500).astype(np.uint64))
    b = np.r_[a[20:], hashing.mix(rng.integers(0, 1 << 62, 15).astype(np.uint64))]
    keys = [set(parity_join.sketch(x, 3, 60, 10)[1].tolist()) for x in (a, b)]
    assert len(keys[0] - keys[1]) <= 35


def test_jaccard_edges(spark):
    assert parity_join.link_components(empty(spark), 3, 90, 100).isEmpty()
    rows = parity_join.link_components(awkward(spark), 3, 90, 100).collect()
    assert len(rows) == 7
    assert {(r["doc_id"], r["component_id"]) for r in rows} == {(None, None), (1, 1), (2, 1), (3, 3)}


def test_components_of_random_graphs(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    of = smallest({n for link in links for n in link}, links)
    lone = {a for a, b in links if a == b} - {n for a, b in links if a != b for n in (a, b)}
    assert {r["node"]: r["component"] for r in components(frame).collect()} == {n: c for n, c in of.items() if n not in lone}
    assert components(frame.limit(0)).isEmpty()


# sentence spans


def test_sentence_bounds_join_to_the_text():
    for text in [*HARD, "A b. C d! E?\nF. ", "\n\n a.b c. \n"]:
        bounds = sentence_spans.sentence_bounds(text)
        assert "".join(text[a:b] for a, b in bounds) == text


def covered(texts, runs):
    """(text, sentences, removed) of each document: sentences of every run that stands earlier go, ``runs`` names them."""
    first, expected = {}, {}
    for doc, text in enumerate(texts):
        sentences = [text[a:b] for a, b in sentence_spans.sentence_bounds(text)] if text else []
        plain, gone = [tuple(s.lower().split()) for s in sentences], set()
        held = [k for k, s in enumerate(plain) if s]
        for i, j in runs([len(plain[k]) for k in held]):
            if first.setdefault(tuple(plain[k] for k in held[i : j + 1]), (doc, i)) != (doc, i):
                gone |= set(range(held[i], held[j] + 1))
        expected[doc] = (None if text is None else "".join(s for i, s in enumerate(sentences) if i not in gone), len(sentences), len(gone))
    return expected


def plain_size_runs(lengths, least=12):
    """All shortest runs from and up to a sentence, found by trying every run."""
    n, out = len(lengths), {(0, 0)} if len(lengths) == 1 and lengths[0] >= least else set()
    enough = [(i, j) for i in range(n) for j in range(i + 1, n) if sum(lengths[i : j + 1]) >= least]
    out |= {min((r for r in enough if r[0] == i), key=lambda r: r[1]) for i in range(n) if any(r[0] == i for r in enough)}
    return sorted(out | {max((r for r in enough if r[1] == j), key=lambda r: r[0]) for j in range(n) if any(r[1] == j for r in enough)})


def test_repeated_spans_equal_brute_force(spark, documents, texts):
    mixed = [t for t in texts if not t or len(t) < 5_000]
    frame = spark.createDataFrame(list(enumerate(mixed)), "doc_id bigint, text string")
    rows = lambda out: {r["doc_id"]: (r["text"], r["n_sentences"], r["n_removed"]) for r in out.collect()}
    assert rows(sentence_spans.drop_repeated_spans(frame)) == covered(mixed, plain_size_runs)
    assert any(v[2] for v in covered(mixed, plain_size_runs).values())

    def threes(lengths):
        width = min(3, len(lengths))
        return [(i, i + width - 1) for i in range(len(lengths) - width + 1) if width and sum(lengths[i : i + width]) >= 12]

    assert rows(sentence_spans.drop_repeated_spans(documents, span=3)) == covered(texts, threes)


def test_spans_of_long_texts(spark):
    n = 2_000_000
    hard = [" " * n, "\n" * n, "a" * n, " \n" * (n // 2), ". " * (n // 2), "one. " * 30_000, "one. " * 30_000]
    frame = spark.createDataFrame(list(enumerate(hard)), "doc_id bigint, text string")
    start = time.time()
    got = {r["doc_id"]: r for r in sentence_spans.drop_repeated_spans(frame, word_run=sentence_spans.WORD_RUN).collect()}
    assert time.time() - start < 120
    assert [got[i]["text"] == hard[i] for i in range(4)] == [True] * 4
    # A run that comes again one sentence later takes all but the first sentence with it.
    assert [got[i]["text"] for i in (4, 5, 6)] == [". ", "one. ", ""]


@pytest.mark.parametrize("sentences", [1, 2, 20])
def test_passages_between_words_are_found_whatever_their_sentences(spark, sentences):
    rng = random.Random(5)
    own = [f"p{i}" for i in range(50)]
    for k in range(1, sentences + 1):
        own[50 * k // sentences - 1] += "."
    rows = []
    for i in range(8):  # the passage starts and ends within a sentence of each document
        rows.append((i, f"{prose(rng, 40, 9000)} h{i} {' '.join(own)[:-1]} t{i} {prose(rng, 40, 9000)}"))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in sentence_spans.drop_repeated_spans(frame, word_run=sentence_spans.WORD_RUN).collect()}
    assert got[0]["text"] == rows[0][1]
    alone = [w for w in rows[0][1].split() if w.startswith("p")]
    for i, text in rows[1:]:
        left = got[i]["text"].split()
        stay = [w for w in left if w in alone]
        assert len(stay) <= 2 * (sentence_spans.WINDOW - 1)
        assert [w for w in left if w not in alone] == [w for w in text.split() if w not in alone]
        cuts = got[i]["cuts"]
        edges = [0, *cuts, len(text)]
        assert "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) == got[i]["text"]


def test_runs_by_size_cover_every_passage_of_whole_sentences():
    rng = random.Random(9)
    for _ in range(300):
        texts = [[rng.choice([1, 2, 3, 8, 20, 30]) for _ in range(rng.randrange(1, 12))] for _ in range(3)]
        numbers = np.repeat(np.arange(3), [len(t) for t in texts])
        first, last = sentence_spans.size_runs(np.array(sum(texts, [])), numbers, 12)
        for t, lengths in enumerate(texts):
            head = int(np.searchsorted(numbers, t))
            found = [(int(a) - head, int(b) - head) for a, b in zip(first, last, strict=True) if numbers[a] == t]
            assert sorted(found) == sorted(plain_size_runs(lengths))
            if len(lengths) > 1 and sum(lengths) >= 12:
                assert {k for a, b in found for k in range(a, b + 1)} == set(range(len(lengths)))


def test_chosen_places_depend_on_the_passage_alone():
    rng = np.random.default_rng(4)
    passage = rng.integers(1, 1 << 60, 40, np.uint64)
    sides = [rng.integers(1, 1 << 60, n, np.uint64) for n in (31, 47, 5, 90)]
    chosen = []
    for before, after in (sides[:2], sides[2:]):
        hashes = np.concatenate([before, passage, after])
        found = sentence_spans.chosen_places(hashes, np.zeros(len(hashes), np.int64), 12)
        chosen.append({int(x) - len(before) for x in found})
        assert all(any(x <= y < x + 12 for y in found) for x in range(len(hashes) - 11))
    assert {x for x in chosen[0] if 11 <= x <= 28} == {x for x in chosen[1] if 11 <= x <= 28} != set()
    texts = np.repeat([0, 1, 2], [20, 3, 17])  # a short text has one place, and no window reaches over two texts
    found = sentence_spans.chosen_places(np.concatenate([passage[:20], passage[:3], passage[:17]]), texts, 12)
    alone = [sentence_spans.chosen_places(passage[:n], np.zeros(n, np.int64), 12) + at for n, at in ((20, 0), (3, 20), (17, 23))]
    assert found.tolist() == np.concatenate(alone).tolist()


def test_spans_and_lines_keep_columns_that_clash(spark):
    for out in (sentence_spans.drop_repeated_spans(awkward(spark)), line_frequency.drop_site_lines(awkward(spark))):
        assert out.columns[:11] == awkward(spark).columns and out.count() == 7
        assert {r["page"] for r in out.collect()} == {"z"}
    assert sentence_spans.drop_repeated_spans(empty(spark)).isEmpty()
    assert line_frequency.drop_site_lines(empty(spark)).isEmpty()


# embeddings


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(40, 16))
    x = np.concatenate([centers.repeat(15, 0) + rng.normal(scale=0.12, size=(600, 16)), rng.normal(size=(500, 16))])
    x[5] = x[3]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] * 16), (2004, []), (2005, [1.0])]
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>").selectExpr("*", "1 as id", "2 as size")
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(near), strict=True)]
    of = smallest([i for i, _ in rows + odd], links)
    got = {r["vec_id"]: r for r in small_world.near_duplicates(frame).collect()}
    assert set(got) == set(of)
    found = sum(r["n_links"] for r in got.values())
    assert 0.98 * len(links) <= found <= len(links)
    assert np.mean([got[i]["component_id"] == c for i, c in of.items()]) > 0.98
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i, _ in odd)
    assert small_world.near_duplicates(frame.limit(0)).isEmpty()
    assert small_world.near_duplicates(frame.where("vec_id = 2001")).count() == 1


def test_vectors_of_several_dimensions(spark):
    rng = np.random.default_rng(8)
    rows, links = [], []
    for dim in (3, 7, 16):
        x = rng.normal(size=(5, dim)).repeat(4, 0)
        x[::4] += 1e-3
        head = len(rows)
        rows += [(head + i, v.tolist()) for i, v in enumerate(x)]
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        links += [(head + int(a), head + int(b)) for a, b in zip(*np.nonzero(unit @ unit.T >= 0.9), strict=True) if a != b]
    rows.append((len(rows), [1.0, 2.0]))
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r["vec_id"]: r for r in small_world.near_duplicates(frame).collect()}
    of, n = smallest([i for i, _ in rows], links), collections.Counter(a for a, _ in links)
    assert {i: r["component_id"] for i, r in got.items()} == of and all(r["n_links"] == n[i] for i, r in got.items())


def test_audit_sees_each_vector(spark):
    nodes = spark.createDataFrame(
        [(np.array(v, np.float64).tobytes(), i, 1) for i, v in enumerate([[1.0, 0.0], [1.0, 0.01], [0.0, 1.0], [0.01, 1.0], [0.02, 1.0]])],
        "v binary, id bigint, size bigint",
    )
    counts = lambda *n: spark.createDataFrame([(i, k) for i, k in enumerate(n) if k], "l_id bigint, linked bigint")
    assert small_world._brute_links(nodes, [(0, np.array([1.0, 0.0]).tobytes())], 2, 0.9) == {0: 1}
    assert small_world._enough(nodes, counts(1, 1, 2, 2, 2), 2, 0.9)
    assert not small_world._enough(nodes, counts(0, 0, 2, 2, 2), 2, 0.9)


def test_first_search_finds_pairs_among_many_others():
    """Pairs in a shard of unrelated vectors: the layers alone miss some of them with the first beam."""
    rng = np.random.default_rng(12)
    x = small_world.unit(rng.normal(size=(14_000, 64)))
    x[::7] = small_world.unit(x[1::7] + rng.normal(scale=0.02, size=(2000, 64)))
    graph = small_world.Graph.build(x)
    nearest = {int(i): set(nodes.tolist()) for at in (0, 7000) for i, nodes in ((at + i, n) for i, n in graph.near(x[at : at + 7000], small_world.BEAM, 0.9, True))}
    close = x @ x.T >= 0.9
    true = {i: set(np.flatnonzero(close[i]).tolist()) for i in range(len(x))}
    assert all(nearest[i] <= true[i] for i in nearest)
    paired = [i for i, of in true.items() if len(of) > 1]
    assert len(paired) > 3900 and np.mean([nearest.get(i, set()) == true[i] for i in paired]) > 0.998
    assert not graph.seen.any()


def test_large_groups_are_found_whole():
    rng = np.random.default_rng(13)
    x = small_world.unit(np.concatenate([rng.normal(size=(1, 32)) + rng.normal(scale=0.2, size=(700, 32)), rng.normal(size=(1300, 32))]))
    graph, close = small_world.Graph.build(x), x @ x.T >= 0.9
    for short in (True, False):
        found = {i: len(nodes) for i, nodes in graph.near(x, small_world.BEAM, 0.9, short)}
        assert len(found) == len(x) and close.sum() > 100_000 and sum(found.values()) >= 0.99 * close.sum()


def test_orders_of_one_node_and_equal_sides():
    one = small_world.Graph.build(np.ones((1, 1), np.float32))
    assert [(i, n.tolist()) for i, n in one.near(np.ones((2, 1), np.float32), 16, 0.9, True)] == [(0, [0]), (1, [0])]
    assert list(one.near(-np.ones((1, 1), np.float32), 16, 0.9, True)) == []


def test_each_part_of_a_shard_has_a_task(spark):
    """Shards met in a task before, as their numbers were hashed."""
    from pyspark.sql import functions as F

    for n in (1, 8, 40):
        frame = spark.range(n).select(F.col("id").cast("int").alias("place"))
        dealt = frame.withColumn("task", small_world._own_tasks(spark, n)).repartition(n, "task")
        assert dealt.select(F.spark_partition_id().alias("p")).distinct().count() == n


def test_a_graph_is_sent_once_for_many_queries(spark, monkeypatch):
    seen = []
    rng = np.random.default_rng(14)
    x = rng.normal(size=(30_000, 2))
    nodes = small_world._as_bytes(spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)], "id bigint, size bigint, v array<double>"), 2)
    real = small_world._own_tasks
    monkeypatch.setattr(small_world, "_own_tasks", lambda spark, n: seen.append(n) or real(spark, n))
    graphs = small_world.build_graphs(nodes.where("id < 40"), 2, 2)
    found = small_world.search_graphs(graphs, nodes.select("id", "v"), 2, 2, 16, 0.9, True)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    links = (unit @ unit[:40].T >= 0.9).sum() - 40
    assert seen == [2] and found.where("kind = 0").groupBy().sum("b").first()[0] == links


def test_vectors_in_the_shorter_floats_that_hold_them(spark):
    rows = [(0, [0.5, -3.0]), (1, [0.1, 2.0]), (2, [1e300, 1.0]), (3, [float(np.float32(0.1)), 0.0])]
    held = small_world._as_bytes(spark.createDataFrame(rows, "id bigint, v array<double>").selectExpr("id", "1L as size", "v"), 2).toArrow()
    assert dict(zip(held["id"].to_pylist(), map(len, held["v"].to_pylist()), strict=True)) == {0: 8, 1: 16, 2: 16, 3: 8}
    assert dict(zip(held["id"].to_pylist(), small_world._rows(held["v"], 2).tolist(), strict=True)) == dict(rows)


def test_a_failed_audit_widens_the_search(spark, monkeypatch):
    searches, real = [], small_world.search_graphs
    monkeypatch.setattr(small_world, "search_graphs", lambda g, q, dim, shards, beam, least, short: searches.append((beam, short)) or real(g, q, dim, shards, beam, least, short))
    monkeypatch.setattr(small_world, "_enough", lambda *a: len(searches) > 2)
    frame = spark.createDataFrame([(i, [1.0, i / 100]) for i in range(20)], "vec_id bigint, embedding array<double>")
    assert all(r["n_links"] == 19 and r["component_id"] == 0 for r in small_world.near_duplicates(frame).collect())
    assert searches == [(16, True), (16, False), (32, False)]


# BPE


def test_bpe_is_the_librarys(spark, documents, texts):
    library, own = Tokenizer.from_file(WORD_FILE), bpe.Codec(WORD_FILE)
    for text in HARD + [t for t in texts if t]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.encode_decode(text) == (array("I", ids).tobytes(), library.decode(ids, skip_special_tokens=False))
    rows = {r["doc_id"]: r for r in bpe.encode_documents(documents, WORD_FILE).collect()}
    assert all(rows[i]["ids"] == library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts))
    assert bpe.encoded_digests(awkward(spark), WORD_FILE).count() == 7
    assert bpe.encoded_digests(empty(spark), WORD_FILE).isEmpty()


# pipeline


def test_pipeline_keeps_clean_documents_once(spark, texts):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(400)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "site_lines", "near_copies", "sentence_spans", "packing"]
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, "/root/testdata/sf0.01")
        if name != "packing":
            assert docs.columns == before.columns
            counts.append(docs.count())
    assert 400 > counts[0] == counts[1] > counts[2] == counts[3] > 250
    assert docs.select("doc_id").distinct().count() == counts[3]
    assert collections.Counter(docs.columns)["sequence_id"] == 1


def plain_stages(docs):
    """Stages 2 to 4 in plain Python over {id: (text, source)}: the texts that are left."""
    # Lines on more than 8 % of a site's distinct pages, and on two at least, go.
    pages = collections.defaultdict(set)
    for text, source in docs.values():
        pages[source].add(text)
    held = collections.Counter((s, line) for s, texts in pages.items() for t in texts for line in {x.strip(" ") for x in t.split("\n")})
    bad = {(s, line) for (s, line), n in held.items() if line and n > 1 and n > 0.08 * len(pages[s])}
    lined = {i: "\n".join(x for x in t.split("\n") if (s, x.strip(" ")) not in bad) for i, (t, s) in docs.items()}
    # One document of each group of near copies stays.
    sets = {}
    for i, t in lined.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    links = [(a, b) for a in sets for b in sets if a < b and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]) > 0]
    of = smallest(list(sets), links)
    kept = {i: t for i, t in lined.items() if of[i] == i}
    # What a run covers that stands in an earlier place goes.
    first, out = {}, {}
    for i in sorted(kept):
        found = sentence_spans.batch_runs([kept[i]], sentence_spans.MIN_WORDS, None, sentence_spans.WORD_RUN)
        runs = sorted(zip(*(found[n].tolist() for n in ("at", "to", "h", "g")), strict=True))
        gone = [(at, to) for at, to, h, g in runs if first.setdefault((h, g), (i, at)) != (i, at)]
        out[i] = sentence_spans.without(kept[i], sentence_spans.characters(kept[i], gone))[0]
    return lined, kept, out


def test_pipeline_equals_plain_python(spark, tmp_path):
    rng = random.Random(21)
    passage = ". ".join(prose(rng, 11, 4000).replace(".", "") for _ in range(8))
    rows = []
    for i in range(90):
        source, text = f"s{i % 4}", prose(rng, rng.randrange(60, 250), 4000)
        if i % 3 == 0:
            text += f"\nfooter of {source}"
        if i % 10 == 4:
            text = f"{prose(rng, 40, 4000)} {passage} {prose(rng, 40, 4000)}"
        rows.append((i, text, "en", source, len(text)))
    for i in range(90, 110):  # copies, exact or with a word changed
        words = rows[i % 30][1].split(" ")
        if i % 2:
            words[len(words) // 2] = "changed"
        rows.append((i, " ".join(words), "en", rows[i % 30][3], 0))
    junk = [(i, "zq zq " * rng.randrange(40, 120), "en", "s9", 0) for i in range(110, 150)]
    docs = spark.createDataFrame(rows + junk + [(150, None, "en", "s0", 0), (151, "", "en", "s0", 0)], DOCS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(i < 110), 0) for i in range(0, 150, 2)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    good = corpus_pipeline.good_documents(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path))
    passed = {r["doc_id"]: (r["text"], r["source"]) for r in good.collect()}
    # So few labels leave the classifier unsure of some; the stages after it are held to what it keeps.
    assert len(set(passed) & set(range(110))) > 50 and not set(passed) & set(range(110, 150))
    lined, kept, texts = plain_stages({i: v for i, v in passed.items() if v[0]})
    assert any(lined[i] != passed[i][0] for i in lined) and len(kept) < len(lined) and any(texts[i] != kept[i] for i in kept)

    out = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    library = Tokenizer.from_file(BYTE_FILE)
    ids = {i: library.encode(t, add_special_tokens=False).ids + [2] for i, t in texts.items()}
    ids |= {i: [2] for i in passed if not passed[i][0]}
    assert set(out["doc_id"]) == set(ids)
    for doc, own in out.sort_values("piece").groupby("doc_id"):
        assert own["start"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]] and own["length"].sum() == len(ids[doc])
        for start, length, crc in zip(own["start"], own["length"], own["ids_crc32"], strict=True):
            assert crc == zlib.crc32(array("I", ids[doc][start : start + length]).tobytes())
    for _, own in out.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]] and own["length"].sum() <= 1024
    assert out["sequence_id"].nunique() <= -(-out["length"].sum() // 1024) + 2


def test_pipeline_of_hard_texts(spark):
    """White space and repeats of a million characters, and equal texts, pass all stages but the first."""
    n = 1_000_000
    hard = [" " * n, "\n" * n, "a" * n, "\t \n" * (n // 3), "ab " * 30_000, "ab " * 30_000, "one two three four five six", None, ""]
    docs = spark.createDataFrame([(i, t, "en", f"s{i}", len(t or "")) for i, t in enumerate(hard)], DOCS)
    start = time.time()
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, SF_DIR).cache()
        docs.count()
    assert {r["doc_id"] for r in docs.select("doc_id").distinct().collect()} == {0, 1, 2, 3, 4, 6, 7, 8}
    assert time.time() - start < 240


def test_pipeline_drops_lines_by_their_ratio_on_sites_of_every_size(spark):
    pages = {"one": 1, "six": 6, "thirty": 30}
    lines = {"one": [("all", 1)], "six": [("all", 6), ("once", 1)], "thirty": [("three", 3), ("two", 2)]}
    rows, expected = [], {}
    for site, n in pages.items():
        for i in range(n):
            held = [line for line, on in lines[site] if i < on]
            gone = [line for line, on in lines[site] if on > 1 and on > 0.08 * n]
            expected[len(rows)] = "\n".join([f"{site} {i}", *(x for x in held if x not in gone)])
            text = "\n".join([f"{site} {i}", *held])
            rows.append((len(rows), text, "en", site, len(text)))
    out = corpus_pipeline.without_boilerplate(spark, spark.createDataFrame(rows, DOCS), SF_DIR).collect()
    assert {r["doc_id"]: r["text"] for r in out} == expected


def test_lines_that_end_in_the_number_of_their_place(spark):
    rows = [(i, f"page {i}\nsite 1\nsite 2" if i < 4 else f"page {i}\nsite 1{i}", "en", "s", 0) for i in range(12)]
    out = line_frequency.drop_site_lines(spark.createDataFrame(rows, DOCS)).collect()
    assert {r["doc_id"]: r["text"] for r in out} == {i: f"page {i}" if i < 4 else t for i, t, *_ in rows}


def test_pipeline_of_no_documents(spark):
    docs = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
    assert docs.isEmpty()
