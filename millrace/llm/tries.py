"""Operator 12: the prefix trie of conversations, as double arrays of its shards and merged upper nodes.

* ``rebuild`` makes the sequences of turns (a turn is the SHA-256 of role and text, and the code points of the text); equal sequences
  become one row with a count, so copies weigh no more than one.
* Sequences that share their first ``depth`` turns go to one shard. ``depth`` is 1; where more of them share these than a
  shard should hold, it is doubled for them until they part (``place``). So one first turn of a third of all conversations is
  many shards.
* A task packs its shard into a double array over dense turn ids: the child of slot s by turn c is slot BASE[s] + c if CHECK there is s.
  Turns are numbered as levels come, so the children of a node lie side by side; single children fill the holes.
  Then all its sequences walk the array and leave their counts at the nodes; subtrees are summed from the leaves up.
* Nodes no deeper than ``depth`` may stand in several shards. Their figures are added up by a hash of their turns, and each one's
  share of leaves and saved tokens goes to it and its ancestors (``depth`` at most).
* ``end_hashes``: ids of conversations with the same sequence are range-partitioned, joined into pieces in order, and the pieces
  hashed one after the other, so no task holds the ids of a sequence.

A conversation's turns are one row, 40 bytes each, as a text is one row.

Defined cases: turns of equal number come in the order of their hash; repeated rows are repeated turns; a null role or text is empty; rows
with a null conv_id belong to no conversation and are left out; conversations without turns are members of the root;
other columns are left aside; an empty table gives an empty result, without a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written

#: Turns of a shard, about; small tables take smaller shards.
SHARD_TURNS = 200_000
LEAST_TURNS = 2_000
#: A prefix with no more sequences than this is never split.
LEAST_SEQUENCES = 50
#: Ids that are joined into one piece before they are hashed.
PIECE = 10_000
HEADS, FAMILY = 6, 100


def rebuild(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) of all conversations: the head of their family's first one, then their own turns behind it."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    turn = F.struct(F.col("turn").isNotNull().alias("given"), F.coalesce("turn", F.lit(0)).alias("turn"), key.alias("key"), F.length(text).cast("long").alias("chars"))
    rows = conversations.filter("conv_id is not null").select("conv_id", turn.alias("row"))
    turns = F.transform(F.array_sort(F.collect_list("row")), lambda x: F.struct(x["key"].alias("key"), x["chars"].alias("chars")))
    own = written(rows.groupBy("conv_id").agg(turns.alias("turns")), "turns")
    heads = own.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("first"), F.slice("turns", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    met = own.withColumn("first", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "first", "left")
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), h)
    return met.select("conv_id", F.concat(head, F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def _hash(turns: Column) -> Column:
    return F.unhex(F.sha2(F.array_join(F.transform(turns, lambda x: F.hex(x["key"])), ""), 256))


def end_hashes(members: DataFrame) -> DataFrame:
    """(seq, conv_id) to (seq, ends): SHA-256 of the ids of each sequence in order, comma-joined."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids = None, []

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"seq": [now], "first": [ids[0]], "told": [",".join(map(str, ids))]}, schema=PIECES)

        for batch in batches:
            for seq, i in zip(batch.column("seq").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if ids and (seq != now or len(ids) == PIECE):
                    yield told()
                    ids = []
                now = seq
                ids.append(i)
        if ids:
            yield told()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            seqs, ends = [], []
            for seq, told in zip(batch.column("seq").to_pylist(), batch.column("told").to_pylist(), strict=True):
                if seq == now:
                    sha.update(b"," + told.encode())
                    continue
                if now is not None:
                    seqs.append(now)
                    ends.append(sha.hexdigest())
                now, sha = seq, hashlib.sha256(told.encode())
            yield pa.RecordBatch.from_pydict({"seq": seqs, "ends": ends}, schema=ENDS)
        if now is not None:
            yield pa.RecordBatch.from_pydict({"seq": [now], "ends": [sha.hexdigest()]}, schema=ENDS)

    joined = members.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id").mapInArrow(pieces, "seq binary, first long, told string")
    return joined.repartition("seq").sortWithinPartitions("seq", "first").mapInArrow(hashes, "seq binary, ends string")


PIECES = pa.schema([("seq", pa.binary()), ("first", pa.int64()), ("told", pa.string())])
ENDS = pa.schema([("seq", pa.binary()), ("ends", pa.string())])


def sequences(rebuilt: DataFrame) -> DataFrame:
    """Distinct sequences (seq, turns, n, low, ends): how many conversations, the smallest one, the hash of all."""
    keyed = written(rebuilt.select(_hash(F.col("turns")).alias("seq"), "turns", "conv_id"), "rebuilt")
    distinct = keyed.groupBy("seq", "turns").agg(F.count("*").alias("n"), F.min("conv_id").alias("low"))
    return written(distinct.join(end_hashes(keyed.select("seq", "conv_id")), "seq"), "sequences")


def place(seqs: DataFrame, shard_turns: int = SHARD_TURNS, least: int = LEAST_SEQUENCES) -> tuple[DataFrame, int]:
    """Sequences with their ``depth`` and ``shard``, and the number of shards."""
    n, turns = seqs.agg(F.count("*"), F.coalesce(F.sum(F.size("turns")), F.lit(0))).first()
    cores = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-turns // shard_turns), min(cores, turns // LEAST_TURNS))
    most, depth = max(least, -(-n // shards)), 1
    prefix = lambda d: _hash(F.slice("turns", 1, d))
    placed = seqs.withColumn("depth", F.lit(depth)).withColumn("prefix", prefix(depth))
    while True:
        # a sequence that ends within the depth is its prefix and alone
        hot = placed.filter(F.col("depth") == depth).groupBy("prefix").count().filter(F.col("count") > most)
        hot = written(hot.select("prefix", F.lit(True).alias("hot")), "hot-prefixes")
        if hot.isEmpty():
            break
        met, depth = placed.join(hot, "prefix", "left"), 2 * depth
        deeper = F.coalesce("hot", F.lit(False))
        placed = met.withColumn("depth", F.when(deeper, F.lit(depth)).otherwise(F.col("depth"))).withColumn("prefix", F.when(deeper, prefix(depth)).otherwise(F.col("prefix"))).drop("hot")
        placed = written(placed, "placed")
    return placed.withColumn("shard", F.pmod(F.xxhash64("prefix"), F.lit(shards)).cast("int")).drop("prefix"), shards


class DoubleArray:
    """BASE and CHECK; slot 0 is the root. BASE may be below zero."""

    def __init__(self):
        self.base, self.check, self.end = np.zeros(1024, np.int64), np.full(1024, -1, np.int64), 1
        self.check[0] = -2
        self.holes = np.zeros(0, np.int64)

    def _room(self, end: int) -> None:
        if end > len(self.check):
            more = max(end, 2 * len(self.check)) - len(self.check)
            self.base, self.check = np.pad(self.base, (0, more)), np.pad(self.check, (0, more), constant_values=-1)

    def _fit(self, codes: np.ndarray) -> int:
        """A base for codes that lie far apart: in the holes if one of the first few fits, at the end otherwise."""
        for hole in self.holes[:32].tolist():
            slots = hole + codes - codes[0]
            if slots[-1] < self.end and (self.check[slots] == -1).all():
                return hole - int(codes[0])
        start, self.end = self.end, self.end + int(codes[-1] - codes[0]) + 1
        self._room(self.end)
        self.holes = np.r_[self.holes, np.arange(start, self.end)]
        return start - int(codes[0])

    def add(self, parents: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Slots of new children, given by the slot of their parent and their code, sorted by both; a parent comes once."""
        first = np.flatnonzero(np.r_[True, parents[1:] != parents[:-1]])
        counts = np.diff(np.r_[first, len(parents)])
        low = codes[first]
        span = codes[first + counts - 1] - low + 1
        base = np.zeros(len(first), np.int64)
        single, wide = counts == 1, span > 4 * counts + 64
        side = ~single & ~wide
        start, self.end = self.end, self.end + int(span[side].sum())
        self._room(self.end)
        base[side] = start + np.cumsum(span[side]) - span[side] - low[side]
        filled = np.repeat(side, counts)
        slots = np.repeat(base, counts) + codes
        self.check[slots[filled]] = parents[filled]
        if self.end > start:
            self.holes = np.r_[self.holes, start + np.flatnonzero(self.check[start : self.end] == -1)]
        for i in np.flatnonzero(wide).tolist():
            own = slice(first[i], first[i] + counts[i])
            base[i] = self._fit(codes[own])
            self.check[base[i] + codes[own]] = parents[own]
            self.holes = self.holes[self.check[self.holes] == -1]
        n = int(single.sum())
        taken, self.holes = self.holes[:n], self.holes[n:]
        fresh = np.arange(self.end, self.end + n - len(taken))
        self.end += len(fresh)
        self._room(self.end)
        base[single] = np.r_[taken, fresh] - low[single]
        slots = np.repeat(base, counts) + codes
        self.check[slots] = parents
        self.base[parents[first]] = base
        return slots

    def step(self, slots: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Children by code; all must be there."""
        to = self.base[slots] + codes
        if len(to) and not (0 <= to.min() and to.max() < self.end and (self.check[to] == slots).all()):
            raise KeyError("no such child")
        return to


class Shard:
    """The trie of some sequences: turns as numbers in ``flat`` with n + 1 ``offsets``."""

    def __init__(self, flat: np.ndarray, offsets: np.ndarray):
        self.flat, self.offsets, self.sizes = flat, offsets, np.diff(offsets)
        self.array = DoubleArray()
        dense = np.full(int(flat.max()) + 1 if len(flat) else 0, -1, np.int64)
        seen, turns, self.levels = 0, [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        active, at = np.flatnonzero(self.sizes > 0), np.zeros(0, np.int64)
        at = np.zeros(len(active), np.int64)
        depth = 0
        while len(active):
            turn = flat[offsets[active] + depth]
            # turns met for the first time are numbered in the order of their parents
            new = np.flatnonzero(dense[turn] < 0)
            new = turn[new[np.argsort(at[new], kind="stable")]]
            new = new[np.sort(np.unique(new, return_index=True)[1])]
            dense[new] = np.arange(seen, seen + len(new))
            seen += len(new)
            order = np.lexsort((dense[turn], at))
            parent, own = at[order], turn[order]
            head = np.r_[True, (parent[1:] != parent[:-1]) | (own[1:] != own[:-1])]
            slots = self.array.add(parent[head], dense[own[head]])
            self.levels.append(slots)
            turns.append(own[head])
            back = np.empty(len(order), np.int64)
            back[order] = np.cumsum(head) - 1
            depth += 1
            stay = self.sizes[active] > depth
            at, active = slots[back][stay], active[stay]
        self.dense = dense
        self.slots = np.concatenate(self.levels)
        self.turns = np.concatenate(turns)  # the root's is none
        self.node = np.full(self.array.end, -1, np.int64)
        self.node[self.slots] = np.arange(len(self.slots))
        self.parent = np.where(self.slots > 0, self.node[self.array.check[self.slots]], -1)
        self.depth = np.repeat(np.arange(len(self.levels)), [len(s) for s in self.levels])

    def walk(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Level by level: sequences that reach it and their nodes."""
        active = np.arange(len(self.sizes))
        at = np.zeros(len(active), np.int64)
        for depth in range(len(self.levels)):
            yield active, self.node[at]
            stay = self.sizes[active] > depth
            active, at = active[stay], at[stay]
            at = self.array.step(at, self.dense[self.flat[self.offsets[active] + depth]])

    def up(self, values: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Values of nodes plus those of their subtrees, over links from nodes where ``below`` holds."""
        total, ends = values.copy(), np.cumsum([len(s) for s in self.levels])
        for low, high in zip(ends[-2::-1].tolist(), ends[:0:-1].tolist(), strict=True):
            some = low + np.flatnonzero(below[low:high])
            np.add.at(total, self.parent[some], total[some])
        return total


NODES = "key binary, parent binary, above array<binary>, conv_id long, depth long, parent_conv_id long, n_convs long, chars long, n_children long, n_leaves long, saved_tokens long, ends string"


def pack(placed: DataFrame, shards: int) -> DataFrame:
    """Nodes of all shards. With ``key``: shared ones, of which other shards may hold a part; ``parent``: key of a shared parent."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        offsets = np.cumsum([0, *rows.column("keys").combine_chunks().value_lengths().to_pylist()])
        keys = np.array(rows.column("keys").combine_chunks().flatten().to_pylist(), "S32")
        keys, flat = np.unique(keys, return_inverse=True)
        chars = np.zeros(len(keys), np.int64)
        chars[flat] = rows.column("chars").combine_chunks().flatten().to_numpy()
        n, low, depth = (rows.column(c).to_numpy() for c in ("n", "low", "depth"))
        trie = Shard(flat, offsets)
        total = len(trie.slots)
        n_convs, first, reach, end_of = np.zeros(total, np.int64), np.full(total, np.iinfo(np.int64).max), np.zeros(total, np.int64), np.full(total, -1)
        for level, (some, at) in enumerate(trie.walk()):
            np.add.at(n_convs, at, n[some])
            np.minimum.at(first, at, low[some])
            np.maximum.at(reach, at, depth[some])
            over = trie.sizes[some] == level
            end_of[at[over]] = some[over]
        size = np.r_[0, chars[trie.turns[1:]]]
        shared = trie.depth <= reach
        inner = ~shared
        children = np.bincount(trie.parent[1:], minlength=total)
        kin = np.bincount(trie.parent[1:], weights=inner[1:], minlength=total).astype(np.int64)  # children of this shard alone
        leaves = trie.up(((children == 0) & inner).astype(np.int64), inner)
        saved = trie.up(np.where(inner, (n_convs - 1) * size, 0), inner)
        ends = [None, *rows.column("ends").to_pylist()]
        ends = [ends[i + 1] for i in end_of.tolist()]
        key, above = [b""] * total, [[]] * total
        for i in np.flatnonzero(shared).tolist():
            p = int(trie.parent[i])
            key[i] = hashlib.sha256(key[p] + keys[trie.turns[i]].ljust(32, b"\0")).digest() if i else b"root"
            above[i] = [*above[p], key[i]] if i else [key[i]]
        share, parent = shared.tolist(), trie.parent.tolist()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k if s else None for k, s in zip(key, share, strict=True)], pa.binary()),
                pa.array([key[p] if i and share[p] else None for i, p in enumerate(parent)], pa.binary()),
                pa.array([a if s else None for a, s in zip(above, share, strict=True)], pa.list_(pa.binary())),
                pa.array(first),
                pa.array(trie.depth.astype(np.int64)),
                pa.array(first[np.maximum(trie.parent, 0)], mask=trie.parent < 0),
                *[pa.array(x) for x in (n_convs, size, np.where(shared, kin, children), leaves, saved)],
                pa.array(ends, pa.string()),
            ],
            names=[f.split()[0] for f in NODES.split(", ")],
        )

    row = placed.select("shard", F.transform("turns", lambda x: x["key"]).alias("keys"), F.transform("turns", lambda x: x["chars"]).alias("chars"), "n", "low", "depth", "ends")
    return written(row.repartitionById(shards, F.col("shard")).mapInArrow(work, NODES), "nodes")


NONE = hashlib.sha256(b"").hexdigest()
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def finish(nodes: DataFrame) -> DataFrame:
    """Adds up what the shards say of shared nodes and gives one row per node."""
    parts = nodes.filter("key is not null").groupBy("key").agg(
        F.first("parent").alias("parent"), F.first("above").alias("above"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.sum("n_convs").alias("n_convs"), F.first("chars").alias("chars"),
        F.sum("n_children").alias("kin"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("ends").alias("ends"),
    )
    parts = written(parts, "shared")
    children = parts.filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("kids"))
    whole = parts.join(children, "key", "left").withColumn("n_children", F.col("kin") + F.coalesce("kids", F.lit(0)))
    own = whole.select("above", (F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("n_leaves"), (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    sums = own.select(F.explode("above").alias("key"), "n_leaves", "saved_tokens").groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    whole = whole.drop("n_leaves", "saved_tokens").join(sums, "key")
    # the root is the parent of many: its smallest member is one number
    root = parts.filter("depth = 0").select("conv_id").first()
    root = F.lit(root[0] if root else None).cast("long")
    lows = parts.filter("depth > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_low"))
    below = whole.select(*[c for c in whole.columns if c in (*RESULT, "parent", "ends")]).unionByName(
        nodes.filter("key is null and parent is not null").select("parent", "ends", *[c for c in RESULT if c not in ("parent_conv_id", "ends_sha256")]), allowMissingColumns=True
    )
    upper = below.filter(F.col("depth") <= 1).withColumn("parent_conv_id", F.when(F.col("depth") == 1, root))
    below = below.filter(F.col("depth") > 1).join(lows, "parent").withColumn("parent_conv_id", F.col("parent_low"))
    rest = nodes.filter("key is null and parent is null")
    rows = [x.withColumn("ends_sha256", F.coalesce("ends", F.lit(NONE))).select(*RESULT) for x in (upper, below, rest)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS, least: int = LEAST_SEQUENCES) -> DataFrame:
    """All nodes of the trie of the rebuilt conversations."""
    return finish(pack(*place(sequences(rebuild(conversations)), shard_turns, least)))
