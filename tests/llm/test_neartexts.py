"""Near-duplicate texts against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import neartexts as near
from millrace.llm.arrays import text_bytes


def family(draw, n_words, copies, share):
    """A text and copies of it in which some words are others."""
    words = [f"w{draw.randrange(5000)}" for _ in range(n_words)]
    out = [" ".join(words)]
    for _ in range(copies):
        own = [w if draw.random() > share else f"w{draw.randrange(5000)}" for w in words]
        out.append(" ".join(own))
    return out


def sets_of(texts):
    out = []
    for t in texts:
        w = (t or "").lower().split()
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(5)
    texts = []
    for _ in range(60):
        texts += family(draw, draw.choice([60, 150, 400]), 3, draw.choice([0.002, 0.005, 0.01, 0.02, 0.1]))
    texts += family(draw, 200, 90, 0.004) + ["", None, "  ", "one two", "One  two", "three"]
    draw.shuffle(texts)
    return texts


def test_recall_and_precision(spark, corpus):
    """Nine tenths of the pairs of 0.8 or more end in one group, and every group is held together by such pairs."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(corpus)], "key_ long, text string").repartition(4)
    root = {r["key_"]: r["root"] for r in near.groups(docs).collect()}
    assert len(root) == len(corpus)
    sets = sets_of(corpus)
    pairs = [(i, j) for i in range(len(corpus)) for j in range(i) if jaccard(sets[i], sets[j]) >= 0.8]
    assert sum(root[i] == root[j] for i, j in pairs) >= 0.9 * len(pairs) and len(pairs) > 500
    parent = list(range(len(corpus)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in pairs:
        parent[top(i)] = top(j)
    assert all(top(i) == top(j) for i in root for j in root if i < j and root[i] == root[j])


def near_pairs(x, radius):
    def linked(a, b):
        apart = [int(p ^ q).bit_count() for p, q in zip(a, b, strict=True)]
        others = near.SEEN // near.BITS
        return any(d <= radius and sum((apart + apart)[k + 1 : k + 1 + others]) <= near.APART for k, d in enumerate(apart))

    return {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if linked(x[i], x[j])}


@pytest.mark.parametrize("most", [4096, 5])
def test_candidates_connect_all_within_the_radius(spark, most):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**32, (8, near.PRINTS), dtype=np.uint64)
    x = np.concatenate([base, *[base ^ (np.uint64(1) << rng.integers(0, 32, base.shape, dtype=np.uint64)) for _ in range(12)]]).astype(np.uint32)
    x = np.concatenate([x, np.repeat(x[:1], 100, axis=0)])
    rows = [(i, r.astype("<u4").tobytes()) for i, r in enumerate(x)]
    got = {(r["u"], r["v"]) for r in near.candidates(spark.createDataFrame(rows, "id long, prints binary").repartition(3), most=most).collect()}
    want = near_pairs(x.tolist(), near.RADIUS)
    assert got <= want and len(got) < 0.6 * len(want)
    parent = list(range(len(x)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in got:
        parent[top(i)] = top(j)
    assert all(top(i) == top(j) for i, j in want)


def test_other_bits_are_counted_whatever_their_sign():
    w = np.array([[-(2**63), 0], [0, 0], [2**62, -1]], np.int64)
    e = near.Entries(np.arange(3), np.zeros(3, np.uint32), w)
    assert e.near(np.array([0, 0]), np.array([1, 2]), 0).tolist() == [True, False]


@pytest.mark.parametrize("most", [4096, 5])
def test_candidates_of_different_roots_are_all_pairs(spark, most):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**32, (8, near.PRINTS), dtype=np.uint64)
    x = np.concatenate([base, *[base ^ (np.uint64(1) << rng.integers(0, 32, base.shape, dtype=np.uint64)) for _ in range(12)]]).astype(np.uint32)
    x = np.concatenate([x, np.repeat(x[:1], 100, axis=0)])
    roots = rng.integers(0, 3, len(x)).tolist()
    rows = [(i, r.astype("<u4").tobytes(), roots[i]) for i, r in enumerate(x)]
    texts = spark.createDataFrame(rows, "id long, prints binary, root long").repartition(3)
    got = {(r["u"], r["v"]) for r in near.candidates(texts, most=most).collect()}
    assert got == {(i, j) for i, j in near_pairs(x.tolist(), near.RADIUS) if roots[i] != roots[j]}


def test_no_pair_of_candidates_is_left_out(spark):
    """A refused link of a forest takes no other pair with it."""
    draw, texts = random.Random(3), []
    for share in (0.012, 0.016, 0.02, 0.024):
        texts += family(draw, 120, 40, share)
    docs = spark.createDataFrame(list(enumerate(texts)), "key_ long, text string").repartition(4)
    root = {r["key_"]: r["root"] for r in near.groups(docs).collect()}
    hashes, bounds, _ = near.shingles(*text_bytes(pa.array(texts)))
    sets, x = sets_of(texts), near.prints(hashes, bounds).tolist()
    pairs = [(i, j) for i, j in near_pairs(x, near.RADIUS) if jaccard(sets[i], sets[j]) >= 0.8]
    assert len(pairs) > 500 and all(root[i] == root[j] for i, j in pairs)


def test_refused_pairs_are_not_walked(spark, monkeypatch):
    """Only confirmed links go through the rounds of components, as there may be many refused pairs in a large group."""
    draw, walked, plain = random.Random(3), [], near.connected
    docs = spark.createDataFrame(list(enumerate(family(draw, 200, 40, 0.005))), "key_ long, text string")

    def counted(edges, *more):
        walked.append(edges.count())
        return plain(edges, *more)

    monkeypatch.setattr(near, "connected", counted)
    assert near.groups(docs, least=1.01).select("root").distinct().count() == docs.select("text").distinct().count() > 5
    assert walked and not any(walked)


def test_prints_by_hand():
    texts = ["a b c d e f a b c d e f", "x", "", "Q r s t"]
    data, offsets = text_bytes(pa.array(texts))
    hashes, bounds, digests = near.shingles(data, offsets)
    assert np.diff(bounds).tolist() == [8, 1, 0, 1]
    assert hashes[0] == hashes[6] and len(set(digests)) == 4
    found = near.prints(hashes, bounds)
    for k in range(near.PRINTS):
        own = near.mixed(hashes[:8] + np.uint64(k // 2 + 1))
        own = (own >> np.uint64(32 if k % 2 == 0 else 0)).astype(np.uint32)
        assert found[0, k] == sum(1 << b for b in range(32) if 2 * sum(int(h) >> b & 1 for h in own) > 8)
    assert not found[2].any()


def test_defined_cases(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(3, "same text"), (1, "Same  text"), (None, "same text"), (2, None), (5, ""), (9, long), (8, long + " more"), (7, "same text"), (7, "same text"), (4, "other words here")]
    docs = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, digest string, id int")
    got = near.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == [1, 2, 4, 8]
    assert near.keep_one(docs.limit(0)).count() == 0
