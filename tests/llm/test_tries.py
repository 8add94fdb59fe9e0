"""The conversation trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from millrace.llm import tries
from millrace.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members, ended = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built = own.get(c - c % 100, [])[:h] + turns[h:]
        for d in range(len(built) + 1):
            members[tuple(built[:d])].append(c)
        ended[tuple(built)].append(c)
    children, out = defaultdict(int), []
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1]) if p else 0
    for p, cs in members.items():
        sha = hashlib.sha256(",".join(map(str, sorted(ended[p]))).encode()).hexdigest()
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p], sha))
    return sorted(out, key=str)


def found(df):
    assert df.columns == tries.RESULT
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query(spark, folder):
    table = pq.read_table(f"/root/testdata/{folder}/conversations.parquet").to_pylist()
    want = brute([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table])
    assert found(QUERIES["op12_conversation_trie"](spark, f"/root/testdata/{folder}")) == want


def drawn(seed, n, texts):
    """Conversations that share turns at all depths: a hot first turn, copies, long ones."""
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(n * 2), n):
        copied = draw.random() < 0.3
        turns = ["hot", "same", "again"] if copied else ["hot"] * (draw.random() < 0.5) + [draw.choice(texts) for _ in range(draw.choice([1, 2, 3, 6, 12]))]
        rows += [(c, t, draw.choice(["user", "user", None]) if not copied else "user", x) for t, x in enumerate(turns)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,shard_turns,least", [(1, 200_000, 50), (2, 100, 3), (3, 30, 1)])
def test_brute_force(spark, seed, shard_turns, least):
    rows = drawn(seed, 260, ["a", "bé", "c" * 30, None, ""])
    got = found(tries.trie(spark.createDataFrame(rows, SCHEMA).repartition(4), shard_turns, least))
    assert got == brute(rows)


def test_hot_prefix_is_split(spark):
    rows = [(c * 7, t, "user", x) for c in range(400) for t, x in enumerate(["hot", f"own {c % 150}", "end"])]
    placed, shards = tries.place(tries.sequences(tries.rebuild(spark.createDataFrame(rows, SCHEMA))), 60, 5)
    sizes = [r["count"] for r in placed.groupBy("shard").count().collect()]
    assert shards > 3 and max(sizes) < 0.5 * sum(sizes)
    assert placed.filter("depth > 1").count() > 0


def test_pieces_of_ids(spark, monkeypatch):
    monkeypatch.setattr(tries, "PIECE", 7)
    rows = [(c, 0, "user", "same") for c in range(300)]
    assert found(tries.trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_defined_cases(spark):
    rows = [(None, 0, "user", "lost"), (7, None, None, None), (7, None, None, None), (7, 2, "user", "x"), (7, 2, "bot", "x"), (205, 0, None, "y"), (200, 1, "", "y")]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA + ", shard int, key string")
    assert len(found(tries.trie(docs))) == len(brute(rows))
    assert [r[:2] for r in found(tries.trie(docs))] == [r[:2] for r in brute(rows)]
    assert found(tries.trie(docs.limit(0))) == []
    assert found(tries.trie(docs.filter("conv_id is null"))) == []


def test_double_array():
    draw = random.Random(11)
    seqs = [[draw.randrange(40) for _ in range(draw.randrange(6))] for _ in range(300)] + [[0, 39_999], [0, 5], [0, 20_000], [1, 39_998], [1, 7]]
    flat, offsets = np.array([t for s in seqs for t in s]), np.cumsum([0, *map(len, seqs)])
    trie = tries.Shard(flat, offsets)
    prefixes = {tuple(s[:d]) for s in seqs for d in range(len(s) + 1)}
    assert len(trie.slots) == len(prefixes) == len(set(trie.slots.tolist()))
    at = {tuple(seqs[i][:level]): int(node) for level, (some, nodes) in enumerate(trie.walk()) for i, node in zip(some.tolist(), nodes.tolist(), strict=True)}
    assert len(set(at.values())) == len(prefixes)
    assert all(trie.parent[node] == at[p[:-1]] for p, node in at.items() if p)
    with pytest.raises(KeyError):
        trie.array.step(np.array([0]), np.array([99_999]))
