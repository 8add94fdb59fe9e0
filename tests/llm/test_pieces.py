"""Encoding and decoding against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from sentencepiece import SentencePieceProcessor

from millrace.llm import pieces
from millrace.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def codec():
    return pieces.Pieces(pieces.Vocabulary(PATH))


def encoded(codec, texts):
    return [np.frombuffer(x, "<i4").tolist() for x in codec.encode(texts)]


def test_random_texts(codec, model):
    draw = random.Random(3)
    alphabets = ["abc", "aab", "the anding ", "é日本語 ▁a", "\n\t x0Ω😀", "abcdefghijklmnopqrstuvwxyz", "ABCDEFabcdef0123456789+/=", "  a", "\0<s>"]
    texts = ["".join(draw.choice(a) for _ in range(draw.choice([0, 1, 5, 30, 70, 300]))) for a in alphabets for _ in range(25)]
    vocabulary = [model.id_to_piece(i) for i in range(3, 32000)]
    texts += ["".join(draw.choice(vocabulary) for _ in range(draw.randrange(1, 60))) for _ in range(200)]
    assert encoded(codec, texts) == model.encode(texts)


@pytest.mark.parametrize("text", ["a" * 50_000, "the" * 20_000, " " * 30_001, "\n" * 20_000, "日本" * 9_000, "ab " * 400_000, ""])
def test_long_texts(codec, model, text):
    assert encoded(codec, [text]) == [model.encode(text)]


def test_decode_any_ids(codec, model):
    draw = random.Random(5)
    some = [[draw.choice([draw.randrange(32000), draw.randrange(3, 259), draw.randrange(3), 28705, 259]) for _ in range(draw.randrange(12))] for _ in range(1500)]
    flat = np.array([i for ids in some for i in ids], np.int64)
    assert codec.decode(flat, np.cumsum([0, *map(len, some)])) == [model.decode(ids) for ids in some]
    with pytest.raises(ValueError):
        codec.decode(np.array([40_000]), np.array([0, 1]))


def test_words_are_forgotten(codec, model, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 3)
    texts = [f"word{i} other{i % 3}" for i in range(50)]
    assert [x for t in texts for x in encoded(codec, [t])] == model.encode(texts)


def test_query(spark, model):
    texts = {d["doc_id"]: d["text"] or "" for d in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = {i: (len(ids := model.encode(t)), sha(",".join(map(str, ids))), sha(model.decode(ids))) for i, t in texts.items()}
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op13_piece_codec"](spark, FOLDER).collect()}
    assert got == want


def test_defined_cases(spark):
    shared = pieces.share(spark, PATH)
    rows = [(1, None, 5), (1, "", 6), (None, "two words", 7), (None, "two words", 7)]
    docs = spark.createDataFrame(rows, "id long, text string, own_ int")
    ids = pieces.encode(docs, ["id", "own_"], shared)
    assert sorted((r["own_"], len(r["ids"])) for r in ids.collect()) == [(5, 0), (6, 0), (7, 2), (7, 2)]
    back = pieces.decode(ids, ["own_"], shared)
    assert sorted((r["own_"], r["text"]) for r in back.collect()) == [(5, ""), (6, ""), (7, "two words"), (7, "two words")]
    assert pieces.encode(docs.limit(0), ["id"], shared).count() == 0
    null = spark.createDataFrame([(None,)], "ids array<int>")
    assert pieces.decode(null, [], shared).collect()[0]["text"] is None
