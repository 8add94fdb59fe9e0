"""Operator 11: which tokens of two tokenizers meet in the corpus. Pairs are counted by spilling, outside of memory.

Both tokenizers cut the same bytes. Between two neighbouring cuts of either lies a stretch that one token of A and one of B share: a
link. Cuts that both make close a group.

* ``spill``: a task encodes its texts and gathers links as numbers (A id, B id, place of the document). At ``RUN_LINKS`` links it
  sorts them, adds up equal ones and deals the records out by the A id modulo the number of parts (radix). What a part gets is
  a run, two zstd blobs: its head (pairs and in how many documents of the run each occurs) and its body (documents, links).
* ``count``: the heads of a part are merged over a heap of the runs whose next block is not read yet. Pairs come out in the order of
  their A ids, so the largest count of an A id is known once its last pair has passed. Heads hold a pair once a run, so a
  pair that every document has is no larger than others. Above ``FAN`` runs, bundles of runs are merged first.
* ``contribute``: the counts of a part and its bodies stream through the tasks, sorted by pair both, and give sums per document of a run; these
  go back to the run they came from. A part with many runs is read by several tasks, ``FAN`` runs each.

The runs are one written table, so a lost executor costs no encoding. Nothing but numbers of runs reaches the driver.

Defined cases: a text that is null or empty, or that the tokens of one side do not give back byte by byte (U+2581 becomes a space in
B), has no tokens and zeros; repeated rows count as documents of their own; ids may be null or repeated; very long texts are one
document of one run; other columns are left aside; an empty table gives an empty result. ``pairs`` shows the counts as rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.arrays import pieces as stretches
from millrace.llm.common import Shared, written

RUN_LINKS = 4_000_000
#: Bytes of text whose tokens are aligned together.
STRETCH = 1 << 20
#: Runs that meet in one task, at most.
FAN = 512
#: Pairs of all runs of a part that are unpacked at once, about.
UNPACKED = 2_000_000
BITS = 20  # of an id and of a place in a run
#: How byte-level tokenizers of this family cut a text before they merge; fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as their character and the others as characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in plain}
    return shown | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


class Tokenizers:
    """Both tokenizers as the bytes of their files, and the bytes of every token."""

    def __init__(self, path_a: str, path_b: str):
        with open(path_a, "rb") as a, open(path_b, "rb") as b:
            self.a, self.b = a.read(), b.read()

    def open(self) -> Tokenizers:
        """Inside a task."""
        import tiktoken
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        whole = json.loads(self.a)
        byte_of, model = _byte_of_char(), whole["model"]
        special = {t["id"]: t["content"].encode() for t in whole["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if i not in special}
        self.bytes_a = [b""] * (1 + max([*model["vocab"].values(), *special]))
        for raw, i in [*ranks.items(), *((raw, i) for i, raw in special.items())]:
            self.bytes_a[i] = raw
        library = Tokenizer.from_str(self.a.decode())
        library.encode_special_tokens = True
        self.slow_a = lambda text: library.encode(text, add_special_tokens=False).ids
        # merges in the order of ids and nothing before them but the pattern: ranks say it all, and much faster
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        plain = whole["normalizer"] is None and whole["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.fast_a = None
        if plain and merged == sorted(merged):
            self.fast_a = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        pieces = SentencePieceProcessor(model_proto=self.b)
        self.encode_b = pieces.encode
        self.bytes_b = []
        for i in range(pieces.piece_size()):
            piece = pieces.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode())
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << BITS:
            raise ValueError(f"more than {1 << BITS} ids")
        self.size_a, self.size_b = (np.array([len(t) for t in ts], np.int64) for ts in (self.bytes_a, self.bytes_b))
        self.told_a = np.array([f"{i}{end}".encode() for i in range(len(self.bytes_a)) for end in ",|"])
        self.told_b = np.array([f"{i}{end}".encode() for i in range(len(self.bytes_b)) for end in ",;"])
        return self

    def encode_a(self, text: str) -> list[int]:
        if self.fast_a:
            try:
                return self.fast_a(text)
            except BaseException as error:  # the pattern gives up on very long runs of white space
                if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return self.slow_a(text)

    def both(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of A and B; none where they do not give the text back."""
        if not text:
            return [], []
        a, b = self.encode_a(" " + text), self.encode_b(text)
        raw = (" " + text).encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return [], []
        return a, b


class Aligned:
    """Links and groups of some documents, from their ids of both sides."""

    def __init__(self, t: Tokenizers, found: list[tuple[list[int], list[int]]]):
        self.t, self.n = t, len(found)
        self.a, self.b = (np.array([i for f in found for i in f[side]], np.int64) for side in (0, 1))
        self.n_a, self.n_b = (np.array([len(f[side]) for f in found], np.int64) for side in (0, 1))
        ends_a, ends_b = np.cumsum(t.size_a[self.a]), np.cumsum(t.size_b[self.b])
        cuts = np.zeros(int(ends_a[-1]) + 1 if len(ends_a) else 1, np.uint8)
        cuts[ends_a] = 1
        cuts[ends_b] += 2
        kind = cuts[np.flatnonzero(cuts)]
        self.of_a, self.of_b, both = (kind & 1).astype(np.int64), (kind >> 1).astype(np.int64), (kind == 3).astype(np.int64)
        self.at_a, self.at_b, group = (np.cumsum(x) - x for x in (self.of_a, self.of_b, both))
        self.doc = np.repeat(np.arange(self.n), self.n_a)[self.at_a] if len(kind) else np.zeros(0, np.int64)
        self.group_a, self.group_b = group[self.of_a > 0], group[self.of_b > 0]
        self.n_links = np.bincount(self.doc, minlength=self.n)
        self.n_groups = np.bincount(self.doc, weights=both, minlength=self.n).astype(np.int64)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Each link as A id, B id in one number, and its document."""
        return (self.a[self.at_a] << BITS) | self.b[self.at_b], self.doc

    def told(self) -> list[bytes]:
        """The groups of each document as text."""
        n = int(self.group_a[-1]) + 1 if len(self.group_a) else 0
        up_a, up_b = (np.cumsum(np.bincount(g, minlength=n)) for g in (self.group_a, self.group_b))
        last_a, last_b = (np.r_[g[1:] != g[:-1], True].astype(np.int64)[: len(g)] for g in (self.group_a, self.group_b))
        all_ = np.empty(len(self.a) + len(self.b), f"S{max(self.t.told_a.itemsize, self.t.told_b.itemsize)}")
        if n:
            all_[np.arange(len(self.a)) + np.r_[0, up_b][self.group_a]] = self.t.told_a[2 * self.a + last_a]
            all_[np.arange(len(self.b)) + up_a[self.group_b]] = self.t.told_b[2 * self.b + last_b]
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return [all_[a:b].tobytes().replace(b"\0", b"")[:-1] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def packed(values: np.ndarray) -> bytes:
    """Numbers from 0 on in the narrowest width that holds them, zstd over them."""
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    return bytes([width]) + zstandard.compress(values.astype(f"<u{width}").tobytes(), 3)


def unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob[1:]), f"<u{blob[0]}")


def _steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


class Run:
    """Links of some documents until they are sorted and dealt out."""

    def __init__(self, parts: int):
        self.parts, self.codes, self.links, self.docs = parts, [], 0, 0

    def add(self, aligned: Aligned) -> None:
        pair, doc = aligned.links()
        self.codes.append((pair << BITS) | (doc + self.docs))
        self.links += len(pair)
        self.docs += aligned.n

    def blobs(self) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
        """Of each part: pairs, documents of each pair; places of these documents, links of each."""
        codes = np.concatenate(self.codes) if self.codes else np.zeros(0, np.int64)
        codes.sort()
        head = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]][: len(codes)])
        times = np.diff(np.r_[head, len(codes)])
        codes = codes[head]
        part = (codes >> (2 * BITS)) % self.parts
        order = np.argsort(part.astype(np.uint16 if self.parts < 1 << 16 else np.int64), kind="stable")
        codes, times, part = codes[order], times[order], part[order]
        bounds = np.searchsorted(part, np.arange(self.parts + 1)).tolist()
        for p, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            if low < high:
                pair, place = codes[low:high] >> BITS, (codes[low:high] & ((1 << BITS) - 1)).astype(np.uint32)
                first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
                width = np.uint16 if self.docs < 1 << 16 else np.uint32  # steps wrap around
                yield p, packed(_steps(pair[first])), packed(np.diff(np.r_[first, len(pair)])), packed(_steps(place.astype(width))), packed(times[low:high])


RUN_SCHEMA = "chunk long, place int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, part int, pairs binary, n_docs binary, places binary, times binary"


def _found(t: Tokenizers, texts: pa.Array) -> Iterator[tuple[int, int, list]]:
    """Ids of both sides for the rows from low to high, a stretch of text at a time."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for low, high in stretches(np.r_[0, np.cumsum(sizes, dtype=np.int64)], STRETCH):
        yield low, high, [t.both(x) for x in texts.slice(low, high - low).to_pylist()]


def _with_text(docs: DataFrame, columns: list[str], added: str) -> tuple[DataFrame, str]:
    kept = docs.select(*columns, F.col("text").alias("_".join(["own", *columns])))
    return kept, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]] + [added])


def groups(docs: DataFrame, columns: list[str], tokenizers: Tokenizers) -> DataFrame:
    """``columns`` of all rows, the ids of both sides and the groups as text."""
    shared = Shared(docs.sparkSession, tokenizers)
    kept, schema = _with_text(docs, columns, "a_ids array<int>, b_ids array<int>, groups string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.get().open()
        for batch in batches:
            for low, high, found in _found(t, batch.column(len(columns))):
                own = [pa.array([f[side] for f in found], pa.list_(pa.int32())) for side in (0, 1)]
                told = pa.array([x.decode() for x in Aligned(t, found).told()], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(i).slice(low, high - low) for i in range(len(columns))] + [*own, told], names=[*columns, "a_ids", "b_ids", "groups"])

    return kept.mapInArrow(work, schema)


def spill(docs: DataFrame, columns: list[str], tokenizers: Tokenizers, parts: int, run_links: int = RUN_LINKS) -> DataFrame:
    """Documents (``part`` null) with their own figures, and the runs of links of each chunk of documents by part; written."""
    shared = Shared(docs.sparkSession, tokenizers)
    kept, schema = _with_text(docs, columns, RUN_SCHEMA)
    types = {f.split()[0]: {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]] for f in RUN_SCHEMA.split(", ")}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, chunk, carried = shared.get().open(), TaskContext.get().partitionId() << 24, []

        def rows(n: int, own: list, values: dict) -> pa.RecordBatch:
            own = own or [pa.nulls(n, kind) for kind in carried]
            return pa.RecordBatch.from_arrays(own + [pa.array(values[c], k) if c in values else pa.nulls(n, k) for c, k in types.items()], names=[*columns, *types])

        def runs(run: Run) -> Iterator[pa.RecordBatch]:
            for part, *blobs in run.blobs():
                yield rows(1, [], {"chunk": [chunk], "part": [part]} | {c: [b] for c, b in zip(("pairs", "n_docs", "places", "times"), blobs, strict=True)})

        run = Run(parts)
        for batch in batches:
            carried = [batch.column(i).type for i in range(len(columns))]
            for low, high, ids in _found(t, batch.column(len(columns))):
                if run.links >= run_links or run.docs + high - low > 1 << BITS:
                    yield from runs(run)
                    run, chunk = Run(parts), chunk + 1
                found = Aligned(t, ids)
                shas = [hashlib.sha256(x).hexdigest() if n else "" for x, n in zip(found.told(), found.n_a.tolist(), strict=True)]
                own = [batch.column(i).slice(low, high - low) for i in range(len(columns))]
                place = np.arange(run.docs, run.docs + found.n)
                yield rows(found.n, own, {"chunk": np.full(found.n, chunk), "place": place, "n_a": found.n_a, "n_b": found.n_b, "n_groups": found.n_groups, "n_links": found.n_links, "groups_sha256": shas})
                run.add(found)
        yield from runs(run)

    return written(kept.mapInArrow(work, schema), "links")


class Head:
    """Pairs and counts of one run, block by block."""

    def __init__(self, pairs: bytes, counts: bytes, block: int):
        self.pairs, self.counts, self.block, self.at = np.cumsum(unpacked(pairs), dtype=np.int64), unpacked(counts), block, 0

    def next(self) -> int | None:
        """Reads a block more; the last pair of it, or None if it was the last."""
        self.at = min(self.at + self.block, len(self.pairs))
        return int(self.pairs[self.at - 1]) if self.at < len(self.pairs) else None


def merge(heads: list[tuple[bytes, bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs in order, each once with its sum, from sorted runs of (pairs, counts)."""
    runs = [Head(*h, max(1024, UNPACKED // len(heads))) for h in heads]
    heap = [(last, i) for i, run in enumerate(runs) if (last := run.next()) is not None]
    heapify(heap)
    low = [0] * len(runs)
    while runs:
        # all runs are read at least up to the smallest last pair of those that go on
        bound = heap[0][0] if heap else np.iinfo(np.int64).max
        pairs, counts = [], []
        for i, run in enumerate(runs):
            high = low[i] + int(np.searchsorted(run.pairs[low[i] : run.at], bound, "right"))
            if high > low[i]:
                pairs.append(run.pairs[low[i] : high])
                counts.append(run.counts[low[i] : high].astype(np.int64))
                low[i] = high
        if pairs:
            pair, count = np.concatenate(pairs), np.concatenate(counts)
            order = np.argsort(pair, kind="stable")
            pair = pair[order]
            head = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
            yield pair[head], np.add.reduceat(count[order], head)
        if not heap:
            return
        while heap and heap[0][0] <= bound:
            _, i = heappop(heap)
            if (last := runs[i].next()) is not None:
                heappush(heap, (last, i))


def _best(blocks: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Marks the largest counts of each A id; its pairs may stand in several blocks."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def marked(pair: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        side = pair >> BITS
        head = np.flatnonzero(np.r_[True, side[1:] != side[:-1]])
        most = np.repeat(np.maximum.reduceat(count, head), np.diff(np.r_[head, len(side)]))
        return pair, count, (count == most).astype(np.int64)

    for pair, count in blocks:
        held.append((pair, count))
        pair, count = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        cut = int(np.searchsorted(pair >> BITS, pair[-1] >> BITS))
        if cut:
            yield marked(pair[:cut], count[:cut])
        held = [(pair[cut:], count[cut:])]
    if held:
        yield marked(*held[0])


def _by_group(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, dict]]:
    """Rows one by one with their key, in the order they come."""
    for batch in batches:
        columns = {c: batch.column(c) for c in batch.schema.names}
        for i in range(batch.num_rows):
            row = {c: v[i].as_py() for c, v in columns.items()}
            yield tuple(row[k] for k in keys), row


def count(stored: DataFrame, parts: int, fan: int = FAN) -> DataFrame:
    """How many documents hold each pair: blocks (part, pairs, counts, best)."""
    heads = stored.filter("part is not null").select("part", "chunk", "pairs", "n_docs")
    n = heads.agg(F.count_distinct("chunk")).first()[0]

    def meet(keys: list[str], last: bool):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def told(key: tuple, runs: list) -> Iterator[pa.RecordBatch]:
                if last:
                    for pair, counts, best in _best(merge(runs)):
                        yield pa.RecordBatch.from_pylist([{"part": key[0], "pairs": packed(_steps(pair)), "counts": packed(counts), "best": packed(best)}], schema=BLOCK)
                else:
                    pair, counts = (np.concatenate(x) for x in zip(*merge(runs), strict=True))
                    yield pa.RecordBatch.from_pylist([{"part": key[0], "chunk": key[1], "pairs": packed(_steps(pair)), "n_docs": packed(counts)}], schema=HEAD)

            now, runs = None, []
            for key, row in _by_group(batches, keys):
                if key != now and runs:
                    yield from told(now, runs)
                    runs = []
                now = key
                runs.append((row["pairs"], row["n_docs"]))
            if runs:
                yield from told(now, runs)

        return work

    while n > fan:
        n = -(-n // fan)
        bundles = heads.withColumn("chunk", F.pmod(F.xxhash64("chunk"), F.lit(n)))
        heads = bundles.repartition("part", "chunk").sortWithinPartitions("part", "chunk").mapInArrow(meet(["part", "chunk"], False), "part int, chunk long, pairs binary, n_docs binary")
    dealt = heads.repartitionById(parts, F.col("part")).sortWithinPartitions("part")
    return written(dealt.mapInArrow(meet(["part"], True), "part int, pairs binary, counts binary, best binary"), "pairs")


HEAD = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("pairs", pa.binary()), ("n_docs", pa.binary())])
BLOCK = pa.schema([("part", pa.int32()), ("pairs", pa.binary()), ("counts", pa.binary()), ("best", pa.binary())])


def pairs(counts: DataFrame) -> DataFrame:
    """The counts as rows (a, b, n_docs, best)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, row in _by_group(batches, []):
            pair, n, best = np.cumsum(unpacked(row["pairs"]), dtype=np.int64), unpacked(row["counts"]), unpacked(row["best"])
            arrays = [pa.array((pair >> BITS).astype(np.int32)), pa.array((pair & ((1 << BITS) - 1)).astype(np.int32)), pa.array(n.astype(np.int64)), pa.array(best > 0)]
            yield pa.RecordBatch.from_arrays(arrays, names=["a", "b", "n_docs", "best"])

    return counts.mapInArrow(work, "a int, b int, n_docs long, best boolean")


def contribute(stored: DataFrame, counts: DataFrame, parts: int, fan: int = FAN) -> DataFrame:
    """Sums of each document: (chunk, place, count_sum, n_best), none for documents without links."""
    runs = stored.filter("part is not null").select("part", "chunk", F.col("pairs").alias("a"), F.col("n_docs").alias("b"), F.col("places").alias("c"), F.col("times").alias("d"))
    n = -(-runs.agg(F.count_distinct("chunk")).first()[0] // fan) or 1
    slot = (F.pmod(F.xxhash64("chunk"), F.lit(n)) * parts + F.col("part")).cast("int")
    runs = runs.select(slot.alias("slot"), F.lit(1).alias("kind"), "chunk", "a", "b", "c", "d")
    empty = F.lit(None)
    sets = counts.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("k"), "part", "pairs", "counts", "best")
    sets = sets.select((F.col("k") * parts + F.col("part")).cast("int").alias("slot"), F.lit(0).alias("kind"), empty.cast("long").alias("chunk"), F.col("pairs").alias("a"), F.col("counts").alias("b"), F.col("best").alias("c"), empty.cast("binary").alias("d"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blocks, known = None, [], ()
        for slot, row in _by_group(batches, ["slot"]):
            if slot != now:
                now, blocks, known = slot, [], ()
            if row["kind"] == 0:
                blocks.append((np.cumsum(unpacked(row["a"]), dtype=np.int64), unpacked(row["b"]).astype(np.int64), unpacked(row["c"]).astype(np.int64)))
                continue
            if not known:
                blocks.sort(key=lambda b: b[0][0])
                known = tuple(np.concatenate([b[k] for b in blocks]) for k in range(3))
            at = np.searchsorted(known[0], np.cumsum(unpacked(row["a"]), dtype=np.int64))
            n_docs, steps, times = unpacked(row["b"]), unpacked(row["c"]), unpacked(row["d"]).astype(np.int64)
            place = np.cumsum(steps, dtype=steps.dtype) if len(steps) else steps
            sums = np.zeros((2, int(place.max()) + 1), np.int64)
            for k in (0, 1):
                np.add.at(sums[k], place, np.repeat(known[k + 1][at], n_docs) * times)
            some = np.flatnonzero(sums[0])
            yield pa.RecordBatch.from_pylist([{"chunk": row["chunk"], "places": packed(_steps(some)), "sums": packed(sums[0][some]), "best": packed(sums[1][some])}], schema=SUMS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(chunk: int, sums: np.ndarray) -> pa.RecordBatch:
            some = np.flatnonzero(sums[0])
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(some), chunk)), pa.array(some.astype(np.int32)), pa.array(sums[0][some]), pa.array(sums[1][some])], names=["chunk", "place", "count_sum", "n_best"])

        now, sums = None, np.zeros((2, 0), np.int64)
        for (chunk,), row in _by_group(batches, ["chunk"]):
            if chunk != now:
                if now is not None:
                    yield told(now, sums)
                now, sums = chunk, np.zeros((2, 0), np.int64)
            place = np.cumsum(unpacked(row["places"]), dtype=np.int64)
            if place[-1] >= sums.shape[1]:
                sums = np.pad(sums, ((0, 0), (0, int(place[-1]) + 1 - sums.shape[1])))
            sums[0][place] += unpacked(row["sums"]).astype(np.int64)
            sums[1][place] += unpacked(row["best"]).astype(np.int64)
        if now is not None:
            yield told(now, sums)

    dealt = sets.unionByName(runs).repartitionById(n * parts, F.col("slot")).sortWithinPartitions("slot", "kind")
    back = dealt.mapInArrow(meet, "chunk long, places binary, sums binary, best binary")
    return back.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, "chunk long, place int, count_sum long, n_best long")


SUMS = pa.schema([("chunk", pa.int64()), ("places", pa.binary()), ("sums", pa.binary()), ("best", pa.binary())])


def parts_of(spark: SparkSession) -> int:
    """As many parts as the session has shuffle partitions, 16 at least."""
    return max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))


def align(docs: DataFrame, columns: list[str], tokenizers: Tokenizers) -> DataFrame:
    """``columns`` of all rows with n_a, n_b, n_groups, n_links, n_best, count_sum and the hash of the groups."""
    parts = parts_of(docs.sparkSession)
    stored = spill(docs, columns, tokenizers, parts)
    sums = contribute(stored, count(stored, parts), parts)
    own = stored.filter("part is null").select(*columns, "chunk", "place", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    met = own.join(sums, ["chunk", "place"], "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return met.select(*columns, "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")
