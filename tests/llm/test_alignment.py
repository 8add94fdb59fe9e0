"""Alignment of two tokenizers against brute force with their libraries."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from millrace.llm import alignment
from millrace.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizers():
    return alignment.Tokenizers(A, B)


def brute(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, hash) of each text, and the counts of pairs."""
    library, pieces = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    library.encode_special_tokens = True
    opened = alignment.Tokenizers(A, B).open()
    links, rows = [], []
    for text in texts:
        a, b, raw = [], [], (" " + (text or "")).encode()
        if text:
            a, b = library.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
        if b"".join(opened.bytes_a[i] for i in a) != raw or b"".join(opened.bytes_b[i] for i in b) != raw:
            a, b = [], []
        spans = []
        for ids, size in ((a, opened.bytes_a), (b, opened.bytes_b)):
            at, own = 0, []
            for i in ids:
                own.append((at, at := at + len(size[i]), i))
            spans.append(own)
        links.append(Counter((x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]))
        cuts = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        told, low = [], 0
        for cut in cuts:
            told.append("|".join(",".join(str(x[2]) for x in own if low <= x[0] and x[1] <= cut) for own in spans))
            low = cut
        rows.append([len(a), len(b), len(cuts), sum(links[-1].values()), hashlib.sha256(";".join(told).encode()).hexdigest() if a else ""])
    count = Counter(p for own in links for p in own)
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    best = [sum(n for p, n in own.items() if count[p] == most[p[0]]) for own in links]
    sums = [sum(n * count[p] for p, n in own.items()) for own in links]
    return [(*r[:4], x, y, r[4]) for r, x, y in zip(rows, best, sums, strict=True)], count, most


ODD = ["", None, "a", "<|endoftext|> </s>", "▁ a", "  two  ", "日本語 😀\n\n\tx", "é" * 40, "The end. The end.", "\0", " " * 300]


def texts_of(n):
    draw = random.Random(7)
    words = ["the", "end", "token", "izer", "Ökonomie", "日本", "...", "12345", "\n", " "]
    return ODD + ["".join(draw.choice(words) + draw.choice(["", " "]) for _ in range(draw.randrange(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("run_links,fan,parts", [(10**6, 512, 16), (40, 512, 3), (25, 3, 5)])
def test_brute_force(spark, tokenizers, run_links, fan, parts):
    texts = texts_of(80)
    want, count, most = brute(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc long, text string").repartition(3)
    stored = alignment.spill(docs, ["doc"], tokenizers, parts, run_links)
    counts = alignment.count(stored, parts, fan)
    got = {(r["a"], r["b"]): (r["n_docs"], r["best"]) for r in alignment.pairs(counts).collect()}
    assert got == {p: (n, n == most[p[0]]) for p, n in count.items()}
    sums = {(r["chunk"], r["place"]): (r["n_best"], r["count_sum"]) for r in alignment.contribute(stored, counts, parts, fan).collect()}
    rows = {r["doc"]: r for r in stored.filter("part is null").collect()}
    assert len(rows) == len(texts)
    assert [(r["n_a"], r["n_b"], r["n_groups"], r["n_links"], *sums.get((r["chunk"], r["place"]), (0, 0)), r["groups_sha256"]) for _, r in sorted(rows.items())] == want


def test_query(spark):
    docs = pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()
    want, *_ = brute([d["text"] for d in docs])
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_align_tokenizers"](spark, FOLDER).collect()}
    assert got == {d["doc_id"]: w for d, w in zip(docs, want, strict=True)}


def test_groups(spark, tokenizers):
    rows = [(i, t) for i, t in enumerate(texts_of(5))]
    want, *_ = brute([t for _, t in rows])
    got = {r["doc"]: r for r in alignment.groups(spark.createDataFrame(rows, "doc long, text string"), ["doc"], tokenizers).collect()}
    for i, w in enumerate(want):
        assert (len(got[i]["a_ids"]), len(got[i]["b_ids"])) == w[:2]
        assert w[6] == (hashlib.sha256(got[i]["groups"].encode()).hexdigest() if w[0] else "")


def test_defined_cases(spark, tokenizers):
    rows = [(1, None, 0), (None, "same text", 1), (None, "same text", 2), (3, "same text", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, own_doc_id int")
    got = alignment.align(docs, ["doc_id", "own_doc_id"], tokenizers).collect()
    assert sorted((r["own_doc_id"], r["n_links"] > 0) for r in got) == [(0, False), (1, True), (2, True), (3, True)]
    assert {(r["count_sum"], r["n_best"]) for r in got if r["own_doc_id"]} == {(3 * r["n_links"], r["n_links"]) for r in got if r["own_doc_id"]}
    assert alignment.align(docs.limit(0), ["doc_id"], tokenizers).collect() == []


def test_long_texts(tokenizers):
    opened = tokenizers.open()
    for text in (" " * 200_000 + "x", "a" * 100_000, "word " * 100_000):
        a, b = opened.both(text)
        assert a and b
