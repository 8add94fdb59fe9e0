"""Operator 8: SimHash near-duplicates, found by covering locality-sensitive hashing.

A fingerprint of 64 bits has a bit where over half of the hashes of the text's word shingles have it. Fingerprints
that differ in ``RADIUS`` bits at most are linked. Every bit gets a vector of RADIUS + 1 bits, not zero, dealt out
evenly; each non-zero vector v makes a table that keeps the bits whose vectors have an odd product with v. For any
RADIUS bits some v is even with all of their vectors, so any two fingerprints within the radius agree on all kept bits
of some table: no pair is missed.

Equal fingerprints become one row first. A bucket of more than ``BUCKET`` distinct fingerprints is split by
the same construction over the bits that its table leaves out, again without missing a pair, until buckets are small;
so no task compares more than BUCKET rows with each other. A bucket gives the links of a spanning forest, not all pairs.

Defined cases: null and empty texts, and texts of white space, have fingerprint zero and are linked like any
other; fewer words than a shingle make one shingle; repeated rows and equal texts share a component; a
null id never becomes a component's id unless all its ids are null; other columns are left aside; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.arrays import LOWER, pieces, text_bytes, words
from millrace.llm.common import written
from millrace.llm.components import connected

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Distinct fingerprints that one task compares with each other, at most.
BUCKET = 20_000


def _fingerprints(data: np.ndarray, offsets: np.ndarray, shingle: int) -> np.ndarray:
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    n_words = np.diff(first)
    out = np.zeros(len(n_words), np.uint64)
    if not len(starts):
        return out
    # the words with one space after each, so that a shingle is a slice
    length = ends - starts
    into = np.concatenate([[0], np.cumsum(length + 1)])
    line = np.full(into[-1], 32, np.uint8)
    line[np.arange(length.sum()) + np.repeat(into[:-1] - np.concatenate([[0], np.cumsum(length)[:-1]]), length)] = data[
        np.arange(length.sum()) + np.repeat(starts - np.concatenate([[0], np.cumsum(length)[:-1]]), length)
    ]
    n_shingles = np.where(n_words > 0, np.maximum(1, n_words - shingle + 1), 0)
    of = np.repeat(np.arange(len(n_words)), n_shingles)
    low = np.arange(n_shingles.sum()) + np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(n_shingles)[:-1]]), n_shingles)
    high = np.minimum(low + shingle, first[1:][of])
    text, hash64 = line.tobytes(), xxhash.xxh64_intdigest
    begins, stops = into[low].tolist(), (into[high] - 1).tolist()
    hashes = np.fromiter((hash64(text[a:b], SEED) for a, b in zip(begins, stops, strict=True)), np.uint64, len(begins))
    some = np.flatnonzero(n_shingles)
    edges = np.concatenate([[0], np.cumsum(n_shingles[some])])
    majority = np.zeros((len(some), 64), bool)
    # a few hundred thousand hashes at a time
    at = 0
    while at < len(some):
        to = max(at + 1, int(np.searchsorted(edges, edges[at] + 200_000, "right")) - 1)
        to = min(to, len(some))
        bits = np.unpackbits(hashes[edges[at] : edges[to]].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        sums = np.add.reduceat(bits, edges[at:to] - edges[at], axis=0, dtype=np.int32)
        majority[at:to] = 2 * sums > n_shingles[some[at:to], None]
        at = to
    out[some] = np.packbits(majority, axis=1).view(">u8")[:, 0].astype(np.uint64)
    return out


def fingerprints(docs: DataFrame, columns: list[str], shingle: int = SHINGLE) -> DataFrame:
    """``columns`` and fingerprint (the 64 bits as a signed long) of each document."""
    kept = docs.select(*columns, "text")
    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            prints = np.zeros(len(offsets) - 1, np.uint64)
            for low, high in pieces(offsets):
                prints[low:high] = _fingerprints(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], shingle)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + [pa.array(prints.view(np.int64))], names=[*columns, "fingerprint"])

    return kept.mapInArrow(work, f"{head}, fingerprint long")


def covering_masks(bits: list[int], radius: int = RADIUS) -> list[int]:
    """2**(radius + 1) - 1 masks over ``bits`` such that any ``radius`` of them are outside of some mask."""
    vectors = range(1, 2 ** (radius + 1))
    of = {bit: vectors[i % len(vectors)] for i, bit in enumerate(bits)}
    return [sum(1 << bit for bit in bits if (of[bit] & v).bit_count() % 2) for v in vectors]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest over fingerprints within the radius: breadth first, each new one by a link."""
    x = values.view(np.uint64)
    left, links = np.arange(len(x)), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            node = queue.pop()
            near = np.bitwise_count(x[left] ^ x[node]) <= radius
            links += [(int(values[node]), int(values[n])) for n in left[near]]
            queue += left[near].tolist()
            left = left[~near]
    return links


def _bucket_links(radius: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            ends = np.asarray(lists.offsets).astype(np.int64)
            values = lists.values.to_numpy(zero_copy_only=False)
            pairs = [p for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True) for p in _forest(np.sort(values[a:b]), radius)]
            both = np.array(pairs, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["u", "v"])

    return work


def links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Distinct fingerprints (column x) to edges (u, v) that connect all that lie within the radius."""
    spark = distinct.sparkSession
    found = []
    masks, fan = covering_masks(list(range(64)), radius), 2 ** (radius + 1)
    # (table, mask so far): the masks of a split extend the mask of the bucket that is split
    frame = distinct.select("x", F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("t"), F.lit(_signed(m)).alias("m")) for i, m in enumerate(masks)])).alias("k"))
    frame = frame.select("x", F.col("k.t").alias("t"), F.col("k.m").alias("m"), F.col("x").bitwiseAND(F.col("k.m")).alias("y"))
    known = dict(enumerate(masks))
    while True:
        sizes = frame.groupBy("t", "y").agg(F.count("*").alias("n")).filter("n > 1")
        sizes = written(sizes, "simhash-buckets")
        small = frame.join(sizes.filter(F.col("n") <= bucket).select("t", "y"), ["t", "y"], "left_semi")

        buckets = small.groupBy("t", "y").agg(F.collect_list("x").alias("xs")).select("xs")  # no list is longer than a bucket
        found.append(written(buckets.mapInArrow(_bucket_links(radius), "u long, v long"), "simhash-links"))
        hot = sizes.filter(F.col("n") > bucket)
        tables = [r["t"] for r in hot.select("t").distinct().collect()]  # as many as there are masks, not rows
        if not tables:
            break
        finer = {}
        for t in tables:
            rest = [b for b in range(64) if not known[t] >> b & 1]
            for i, m in enumerate(covering_masks(rest, radius)):
                finer[t * fan + i + 1] = known[t] | m
        again = frame.join(hot.select("t", "y"), ["t", "y"], "left_semi")
        steps = F.explode(F.sequence(F.lit(1), F.lit(fan - 1)))
        again = again.select("x", "t", steps.alias("i")).select("x", (F.col("t") * fan + F.col("i")).alias("t"))
        table = spark.createDataFrame([(t, _signed(m)) for t, m in finer.items()], "t long, m long")
        frame = written(again.join(F.broadcast(table), "t").select("x", "t", "m", F.col("x").bitwiseAND(F.col("m")).alias("y")), "simhash-split")
        known = finer
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def cluster(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fingerprint, …) with root, the fingerprint that names the component, and component_id, its smallest doc_id."""
    groups = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "simhash-groups")
    roots = connected(links(groups.select(F.col("fingerprint").alias("x")), radius, bucket), "simhash-components")
    named = groups.join(roots, F.col("fingerprint") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = named.select("fingerprint", "root").join(least, "root").select("fingerprint", "root", "component_id")
    return prints.join(ids, "fingerprint")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, text) to doc_id, fingerprint in 16 hex digits, component_id."""
    prints = written(fingerprints(docs, ["doc_id"]), "simhash-prints")
    joined = cluster(prints, radius)
    return joined.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest doc_id, all its columns; one of rows that are equal.

    Groups are components of fingerprints, whatever the ids: a null id is the last one, and texts that share an id but
    are not linked both stay.
    """
    key = F.xxhash64("doc_id", "text")
    prints = written(fingerprints(docs.select("doc_id", "text", key.alias("key_")), ["doc_id", "key_"]), "simhash-prints")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key_")
    best = cluster(prints, radius).groupBy("root").agg(F.min(order).alias("best"))
    rows = docs.withColumn("key_", key).join(best.select(F.col("best.key_").alias("key_")), "key_", "left_semi")
    first = F.row_number().over(Window.partitionBy("key_").orderBy(F.lit(1)))
    return rows.withColumn("place_", first).filter("place_ = 1").select(*docs.columns)
