"""Near-duplicate texts by several SimHash fingerprints: what the pipeline's stage of operator 8 keeps.

One fingerprint of 64 bits finds few pairs whose word shingles agree to 0.8: about one bit in seven differs, and the covering
construction doubles its tables with every bit of the radius. Here each text has ``PRINTS`` independent fingerprints of ``BITS`` bits over its
shingles of ``SHINGLE`` words, each searched by covering tables (``simhash.covering_masks``) for all pairs within ``RADIUS`` bits: a pair of
similarity 0.8 is near in one of eight with a chance of 0.92, of 0.85 with 0.98, of 0.9 with 0.999. Candidates are confirmed by the
Jaccard similarity of their sets of shingles, ``LEAST`` or more; groups are components of confirmed links.

Equal word sequences are one text first. Buckets stream through their task and give the links of a spanning forest each, not their
pairs. Those of more than ``PAIRS`` texts keep one text for each fingerprint; those of more than ``BUCKET`` fingerprints pass
on to covering tables over the bits that theirs left out. With 12 bits or fewer left no bucket can have as many, so this ends, and no task
holds more of a bucket. The forests connect all within the radius whose other fingerprints do not rule it out (``APART``).

A link of a forest that is not confirmed may have stood for a pair that would be. So texts that forests connect and confirmed links do not
pass through the buckets once more, with the group they are in, and every pair from different groups is a candidate then: a
pair of candidates alike to ``LEAST`` is always in one group. Their buckets keep all texts of a fingerprint (36 bytes each).

Defined cases: texts without a word are one text; fewer words than a shingle make one shingle; repeated rows give one row; a null id
is the last one; columns may have any names but those that end in an underscore; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.arrays import LOWER, mixed, pieces, prefix_sums, span_hashes, text_bytes, word_hashes, words
from millrace.llm.common import written
from millrace.llm.components import connected
from millrace.llm.simhash import covering_masks
from millrace.operators.lookup import fits_broadcast

SHINGLE = 5
PRINTS, BITS, RADIUS = 8, 32, 3
LEAST = 0.8
#: Bits of other fingerprints that are compared besides, and how many of them may differ. Of texts alike to 0.8 some 20 do (and 42 with a
#: chance of one to millions), of unlike ones 64 (and 42 or fewer with a chance of one to ten thousand), which spares their confirmation.
SEEN, APART = 128, 42
#: Texts of a bucket up to which many buckets are compared at once, and fingerprints up to which it stays in its task.
PAIRS, BUCKET = 64, 4096
#: Texts whose entries are made at once.
TEXTS = 500
#: Pairs whose sets are unpacked at once.
SETS = 500
#: Shingles whose bits are counted at once.
AT_ONCE = 50_000


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Hashes of the shingles of each text, the n + 1 bounds of the texts, and a digest of each text's words."""
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    hashes = word_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    digests = [hashlib.md5(hashes[a:b].tobytes()).digest() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    n_words = np.diff(first)
    count = np.where(n_words > 0, np.maximum(1, n_words - size + 1), 0)
    bounds = np.r_[0, np.cumsum(count)]
    of = np.repeat(np.arange(len(count)), count)
    low = first[of] + np.arange(bounds[-1]) - bounds[of]
    found = span_hashes(prefix_sums(hashes), low, np.minimum(low + size, first[of + 1])) if len(low) else hashes
    return found, bounds, digests


def prints(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """``PRINTS`` fingerprints of each text, 32 bits each: a bit is set where over half of the hashes have it."""
    n = len(bounds) - 1
    out = np.zeros((n, PRINTS), np.uint32)
    some = np.flatnonzero(np.diff(bounds))
    at = 0
    while at < len(some):
        to = min(len(some), max(at + 1, int(np.searchsorted(bounds[some], bounds[some[at]] + AT_ONCE, "right")) - 1))
        low, high = bounds[some[at]], bounds[some[to - 1] + 1]
        counts = np.diff(bounds)[some[at:to], None]
        for k in range(PRINTS // 2):
            bits = np.unpackbits(mixed(hashes[low:high] + np.uint64(k + 1)).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            sums = np.add.reduceat(bits, bounds[some[at:to]] - low, axis=0, dtype=np.int32)
            out[some[at:to], 2 * k : 2 * k + 2] = np.packbits(2 * sums > counts, axis=1).view(">u4")
        at = to
    return out


def _texts(docs: DataFrame) -> DataFrame:
    """(key_, text) to (key_, digest, prints): a digest of the words, the fingerprints as bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for low, high in pieces(offsets):
                hashes, bounds, digests = shingles(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                rows = [r.astype("<u4").tobytes() for r in prints(hashes, bounds)]
                arrays = [batch.column("key_").slice(low, high - low), pa.array(digests, pa.binary()), pa.array(rows, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["key_", "digest", "prints"])

    return docs.select("key_", "text").mapInArrow(work, "key_ long, digest binary, prints binary")


def _sets(docs: DataFrame) -> DataFrame:
    """(id, text) to (id, shingles): the set of hashes of the shingles, packed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for low, high in pieces(offsets):
                hashes, bounds, _ = shingles(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                own = [np.diff(np.unique(hashes[a:b]), prepend=np.uint64(0)) for a, b in pairwise(bounds.tolist())]
                sets = pa.array([pack(x.astype("<u8").tobytes()) for x in own], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(low, high - low), sets], names=["id", "shingles"])

    return docs.select("id", "text").mapInArrow(work, "id long, shingles binary")


def _by_key(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Join on ``key_``; the keys go to the tasks if there are few of them, so that texts are not shuffled for that."""
    return df.join(F.broadcast(keys) if fits_broadcast(keys) else keys, "key_", how)


def _entries(texts: DataFrame, masks: list[int]) -> DataFrame:
    """(id, prints, perhaps root) to one row per fingerprint and table: (tx, id, w0, w1, perhaps root).

    tx is the number of the table and, in its low ``BITS`` bits, the fingerprint; w0 and w1 hold ``SEEN`` bits of other fingerprints of
    the text. What a table keeps of the fingerprint follows from both and does not travel (``_bucket``).
    """
    carried = [c for c in ("id", "root") if c in texts.columns]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.arange(PRINTS * len(masks), dtype=np.int64).reshape(PRINTS, -1) << BITS
        for batch in (part.slice(low, TEXTS) for part in batches for low in range(0, part.num_rows, TEXTS)):
            x = np.frombuffer(b"".join(batch.column("prints").to_pylist()), "<u4").reshape(-1, PRINTS)
            # of fingerprint k the next four
            others = np.stack([np.roll(x, -k - 1, axis=1)[:, : SEEN // BITS] for k in range(PRINTS)], axis=1)
            others = np.repeat(np.ascontiguousarray(others).view("<i8").reshape(-1, 2), len(masks), axis=0)
            own = [np.repeat(batch.column(c).to_numpy(), tables.size) for c in carried]
            arrays = [(x[:, :, None] | tables).ravel(), own[0], others[:, 0], others[:, 1], *own[1:]]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(a)) for a in arrays], names=["tx", "id", "w0", "w1", *carried[1:]])

    return texts.select(*carried, "prints").mapInArrow(work, ", ".join(f"{c} long" for c in ("tx", "id", "w0", "w1", *carried[1:])))


def _bucket(kept: list[int]) -> Column:
    """The bucket of an entry: its table, and the bits of its fingerprint that the table keeps."""
    keeps = ", ".join(f"{(t << BITS) | m}L" for t, m in enumerate(kept))
    return F.expr(f"tx & get(array({keeps}), cast(shiftright(tx, {BITS}) as int))")


class Entries:
    """Entries of a stretch of buckets as arrays; with ``roots``, only texts of different roots are near."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, w: np.ndarray, roots: np.ndarray | None = None):
        self.ids, self.x, self.w, self.roots = ids, x, w, roots

    def at(self, some) -> Entries:
        return Entries(self.ids[some], self.x[some], self.w[some], None if self.roots is None else self.roots[some])

    def near(self, i: np.ndarray, j: np.ndarray, radius: int) -> np.ndarray:
        """Whether the fingerprints lie within the radius, and the other bits not farther apart than those of texts alike."""
        close = np.bitwise_count(self.x[i] ^ self.x[j]) <= radius
        if self.roots is not None:
            close &= self.roots[i] != self.roots[j]
        others = (self.w[i[close]] ^ self.w[j[close]]).view(np.uint64)  # of a negative number the bits of its absolute value would count
        close[close] = np.bitwise_count(others).sum(axis=1) <= APART
        return close


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Numbers of links (i, j) that connect all that the links connect: in each round every tree joins the first of its lower ones."""
    label, kept = np.arange(n), []
    while True:
        a, b = label[i], label[j]
        some = np.flatnonzero(a != b)
        if not len(some):
            return np.concatenate(kept) if kept else some
        low, high = np.minimum(a, b)[some], np.maximum(a, b)[some]
        order = np.lexsort((low, high))
        first = order[np.r_[True, high[order][1:] != high[order][:-1]]]
        kept.append(some[first])
        up = np.arange(n)
        up[high[first]] = low[first]
        while (up != up[up]).any():
            up = up[up]
        label = up[label]


def _pairs(e: Entries, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest over one bucket: breadth first, so that no more than one row of comparisons is held."""
    left, u, v = np.arange(len(e.ids)), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            node = queue.pop()
            near = e.near(np.full(len(left), node), left, radius)
            u += [node] * int(near.sum())
            v += left[near].tolist()
            queue += left[near].tolist()
            left = left[~near]
    return np.array(u, np.int64), np.array(v, np.int64)


def _every(e: Entries, radius: int) -> Iterator[np.ndarray]:
    """All near pairs of one bucket, some rows of comparisons at a time."""
    e = e.at(np.argsort(e.roots, kind="stable"))
    n, after = len(e.ids), np.searchsorted(e.roots, e.roots, "right")
    step = max(1, AT_ONCE // max(1, n))
    for low in range(0, n, step):
        high, begin = min(n, low + step), int(after[low])
        i, j = np.repeat(np.arange(low, high), n - begin), np.tile(np.arange(begin, n), high - low)
        near = e.near(i, j, radius) & (i < j)
        if near.any():
            yield np.stack([e.ids[i[near]], e.ids[j[near]]], axis=1)


class Bucket:
    """One bucket as it streams by: a text for each fingerprint in it; ``hot`` from the time these are too many."""

    def __init__(self, table: int, most: int):
        self.table, self.most, self.hot = table, most, False
        self.held = Entries(np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros((0, 2), np.int64))

    def add(self, e: Entries) -> tuple[np.ndarray, Entries]:
        """Links of equal fingerprints, and entries that have to go on to finer tables."""
        none = np.zeros((0, 2), np.int64)
        if self.hot:
            return none, e
        all_ = Entries(np.r_[self.held.ids, e.ids], np.r_[self.held.x, e.x], np.concatenate([self.held.w, e.w]))
        _, first, of = np.unique(all_.x, return_index=True, return_inverse=True)
        same = all_.near(first[of], np.arange(len(of)), 0) & (all_.ids[first[of]] != all_.ids)
        links = np.stack([all_.ids[first[of]][same], all_.ids[same]], axis=1)
        self.held = all_.at(first)
        if len(first) <= self.most:
            return links, e.at(slice(0, 0))
        self.hot = True
        return links, self.held

    def end(self, radius: int) -> Iterator[np.ndarray]:
        if not self.hot and len(self.held.ids) > 1:
            u, v = _pairs(self.held, radius)
            yield np.stack([self.held.ids[u], self.held.ids[v]], axis=1)


class WholeBucket:
    """One bucket of which every near pair is wanted; ``hot`` from the time its fingerprints are too many."""

    def __init__(self, table: int, most: int):
        self.table, self.most, self.hot = table, most, False
        self.parts, self.seen = [], np.zeros(0, np.uint32)

    def add(self, e: Entries) -> tuple[np.ndarray, Entries]:
        """No links yet, and entries that have to go on to finer tables."""
        none = np.zeros((0, 2), np.int64)
        if self.hot:
            return none, e
        self.parts.append(e)
        self.seen = np.union1d(self.seen, e.x)
        if len(self.seen) <= self.most:
            return none, e.at(slice(0, 0))
        self.hot, on = True, self.whole()
        self.parts = []
        return none, on

    def whole(self) -> Entries:
        return Entries(*[np.concatenate([getattr(e, c) for e in self.parts]) for c in ("ids", "x", "w", "roots")])

    def end(self, radius: int) -> Iterator[np.ndarray]:
        if not self.hot:
            yield from _every(self.whole(), radius)


def _inside(group: np.ndarray, e: Entries, radius: int) -> Iterator[np.ndarray]:
    """Links of spanning forests over many whole buckets, numbered by ``group``; all near pairs if there are roots."""
    size = np.bincount(group)
    small, u, v = size[group] <= PAIRS, [], []
    for step in range(1, int(size[size <= PAIRS].max(initial=0))):
        at = np.flatnonzero((group[step:] == group[:-step]) & small[step:])
        at = at[e.near(at, at + step, radius)]
        u.append(at)
        v.append(at + step)
    if u:
        i, j = np.concatenate(u), np.concatenate(v)
        kept = _forest(len(group), i, j) if e.roots is None else slice(None)
        yield np.stack([e.ids[i[kept]], e.ids[j[kept]]], axis=1)
    for g in np.flatnonzero(size > PAIRS).tolist():
        if e.roots is not None:
            yield from _every(e.at(group == g), radius)
            continue
        bucket = Bucket(0, len(group))
        yield bucket.add(e.at(group == g))[0]
        yield from bucket.end(radius)


def _buckets(entries: DataFrame, kept: list[int], radius: int, most: int) -> DataFrame:
    """Entries to candidate pairs (u, v), and the entries (u: id, v: tx, w0, w1, root) of buckets of more than ``most`` fingerprints.

    ``kept`` are the bits that each table keeps.
    """
    rooted = "root" in entries.columns
    kind, names = (WholeBucket if rooted else Bucket), ["u", "v", "w0", "w1", *(["root"] if rooted else [])]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.array(kept, np.uint32)

        def pairs(found: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for links in found:
                arrays = [pa.array(np.ascontiguousarray(links[:, k])) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*arrays, *[pa.nulls(len(links), pa.int64())] * (len(names) - 2)], names=names)

        def absorbed(e: Entries) -> Iterator[pa.RecordBatch]:
            links, on = bucket.add(e)
            yield from pairs([links])
            arrays = [on.ids, on.x.astype(np.int64) | bucket.table << BITS, on.w[:, 0], on.w[:, 1], *([on.roots] if rooted else [])]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(a)) for a in arrays], names=names)

        now, bucket = None, None
        for batch in batches:
            tx, ids, w0, w1 = (batch.column(c).to_numpy() for c in ("tx", "id", "w0", "w1"))
            t, x = tx >> BITS, (tx & ((1 << BITS) - 1)).astype(np.uint32)
            y = x & keep[t]
            e = Entries(ids, x, np.stack([w0, w1], axis=1), batch.column("root").to_numpy() if rooted else None)
            cut = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (y[1:] != y[:-1])])
            last, inner = int(cut[-1]), 0
            if (int(t[0]), int(y[0])) == now:
                inner = int(cut[1]) if len(cut) > 1 else len(t)
                yield from absorbed(e.at(slice(0, inner)))
            if inner < len(t):
                if bucket:
                    yield from pairs(bucket.end(radius))
                # whole buckets, and the last one, which may go on in the next batch
                if inner < last:
                    group = np.cumsum(np.isin(np.arange(inner, last), cut)) - 1
                    yield from pairs(_inside(group, e.at(slice(inner, last)), radius))
                now, bucket = (int(t[last]), int(y[last])), kind(int(t[last]), most)
                yield from absorbed(e.at(slice(last, None)))
        if bucket:
            yield from pairs(bucket.end(radius))

    dealt = entries.repartition(_bucket(kept)).sortWithinPartitions(_bucket(kept))
    return dealt.mapInArrow(work, ", ".join(f"{c} long" for c in names))


def candidates(texts: DataFrame, radius: int = RADIUS, most: int = BUCKET) -> DataFrame:
    """(id, prints) of distinct texts to pairs (u, v) that connect all texts near in a fingerprint.

    With a column root: all pairs near in a fingerprint whose roots differ.
    """
    masks = covering_masks(list(range(BITS)), radius)
    known = masks * PRINTS
    entries, found = _entries(texts, masks), []
    more = [c for c in ("root",) if c in texts.columns]
    while True:
        both = written(_buckets(entries, known, radius, most), "near-buckets")
        found.append(both.filter("w0 is null").select("u", "v"))
        hot = both.filter("w0 is not null").withColumn("t", F.shiftright("v", BITS))
        tables = sorted(r["t"] for r in hot.select("t").distinct().collect())  # as many as there are masks, not rows
        if not tables:
            break
        # the tables of a hot bucket keep more of the bits, a text without any difference left in the rest shares all of them
        finer = [(t, known[t] | m) for t in tables for m in covering_masks([b for b in range(BITS) if not known[t] >> b & 1], radius)]
        table = texts.sparkSession.createDataFrame([(t, i << BITS) for i, (t, _) in enumerate(finer)], "t long, next long")
        x = F.col("v").bitwiseAND(F.lit((1 << BITS) - 1))
        entries = hot.join(F.broadcast(table), "t").select(F.col("next").bitwiseOR(x).alias("tx"), F.col("u").alias("id"), "w0", "w1", *more)
        known = [m for _, m in finer]
    out = found[0]
    for pairs in found[1:]:
        out = out.unionByName(pairs)
    return out.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, least: float = LEAST) -> DataFrame:
    """Pairs (u, v) whose sets (id, shingles) are alike to ``least`` or more."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        last, one = None, None
        for batch in (part.slice(low, SETS) for part in batches for low in range(0, part.num_rows, SETS)):
            u, v = batch.column("u").to_numpy(), batch.column("v").to_numpy()
            good = np.zeros(len(u), bool)
            for i, (a, b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)):
                if a != last:
                    last, one = a, np.cumsum(np.frombuffer(open_(a), "<u8"), dtype=np.uint64)
                two = np.cumsum(np.frombuffer(open_(b), "<u8"), dtype=np.uint64)
                common = len(np.intersect1d(one, two, assume_unique=True))
                good[i] = common >= least * (len(one) + len(two) - common)
            yield pa.RecordBatch.from_arrays([pa.array(u[good]), pa.array(v[good])], names=["u", "v"])

    left = sets.select(F.col("id").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("id").alias("v"), F.col("shingles").alias("b"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(work, "u long, v long")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components."""
    of = lambda end: roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
    both = pairs.join(of("u"), "u", "left").join(of("v"), "v", "left")
    return both.filter(F.coalesce("root_u", "u") != F.coalesce("root_v", "v")).select("u", "v")


def _met(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Components, each once, that a pair brings together with another one."""
    of = lambda end: roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
    both = pairs.join(of("u"), "u", "left").join(of("v"), "v", "left").select(F.coalesce("root_u", "u").alias("a"), F.coalesce("root_v", "v").alias("b"))
    return both.filter("a <> b").select(F.explode(F.array("a", "b")).alias("root")).distinct()


def groups(docs: DataFrame, radius: int = RADIUS, least: float = LEAST) -> DataFrame:
    """(key_, text) to (key_, root): a number that near-duplicate texts share."""
    texts = written(_texts(docs), "near-texts")
    distinct = texts.groupBy("digest", "prints").agg(F.min("key_").alias("key_")).withColumn("id", F.monotonically_increasing_id())
    distinct = written(distinct, "near-distinct")
    pairs = written(candidates(distinct, radius), "near-pairs")
    wanted = pairs.select(F.col("u").alias("id")).union(pairs.select(F.col("v").alias("id"))).distinct()
    wanted = written(distinct.select("key_", "id").join(wanted, "id", "left_semi"), "near-wanted")
    sets = written(_sets(_by_key(docs.select("key_", "text"), wanted, "inner")), "near-sets")
    # first each text and the smallest of its partners; then only pairs that this has not joined
    first = written(confirmed(pairs.groupBy("v").agg(F.min("u").alias("u")).select("u", "v"), sets, least), "near-first")
    second = written(confirmed(_apart(pairs, connected(first, "near-roots")), sets, least), "near-second")
    links = first.union(second)
    roots = connected(links, "near-components")
    # a refused link may have stood for pairs that a forest leaves out
    whole = wanted.select("id").join(roots.select(F.col("node").alias("id"), "root"), "id", "left").select("id", F.coalesce("root", "id").alias("root"))
    parted = written(whole.join(_met(pairs, roots), "root", "left_semi").select("id", "root"), "near-parted")
    every = candidates(distinct.select("id", "prints").join(parted, "id"), radius)
    every = written(every.join(pairs, ["u", "v"], "left_anti"), "near-every")
    # again a few pairs of each text and group first
    of_u = parted.select(F.col("id").alias("u"), F.col("root").alias("root_u"))
    some = every.join(of_u, "u").groupBy("v", "root_u").agg(F.min("u").alias("u")).select("u", "v")
    links = links.union(written(confirmed(some, sets, least), "near-third"))
    last = _apart(every.join(some, ["u", "v"], "left_anti"), connected(links, "near-roots"))
    links = links.union(written(confirmed(last, sets, least), "near-fourth"))
    roots = connected(links, "near-components")
    ids = distinct.select("digest", "id").join(roots, F.col("id") == F.col("node"), "left")
    ids = ids.select("digest", F.coalesce("root", "id").alias("root"))
    return texts.select("key_", "digest").join(ids, "digest").select("key_", "root")


def keep_one(docs: DataFrame, radius: int = RADIUS, least: float = LEAST) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest doc_id, all its columns; one of rows that are equal."""
    keyed = docs.withColumn("key_", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key_")
    rows = keyed.groupBy("key_", "doc_id").agg(F.count("*").alias("n"))
    found = written(groups(keyed, radius, least).distinct().join(rows, "key_"), "near-rows")
    best = found.groupBy("root").agg(F.min(order).alias("best")).select(F.col("best.key_").alias("key_"), F.lit(True).alias("kept"))
    judged = written(found.select("key_", "n").join(best, "key_", "left"), "near-judged")
    rest = _by_key(keyed, judged.filter("kept is null").select("key_"), "left_anti")
    again = judged.filter("kept and n > 1").select("key_")
    first = F.row_number().over(Window.partitionBy("key_").orderBy(F.lit(1)))
    several = _by_key(rest, again, "left_semi").withColumn("place_", first).filter("place_ = 1")
    return _by_key(rest, again, "left_anti").select(*docs.columns).unionByName(several.select(*docs.columns))
