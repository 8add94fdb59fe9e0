"""Operator 6: benchmark decontamination by greedy string tiling.

Texts of the benchmark and documents are compared as words, lower-cased A-Z, punctuation at their ends taken off. A document
and a test that share a run of ``SEED`` words are a candidate pair. Greedy string tiling then marks the
longest run of unmarked words common to both, again and again, until none of ``LEAST`` words is left; common runs are
found by running Karp-Rabin hashes over windows of the length in question. The marked share of the test is its
coverage, whatever order its parts stand in; from ``COVERAGE`` on the document holds the test.

The benchmark is the stated query set: it goes to the tasks in blocks of at most ``BLOCK_WORDS`` words, so
memory is bounded however large it is, and every document meets every block. Documents never leave their task, only
pairs found do.

Defined cases: null and empty texts match nothing; tests with fewer words than a seed must stand in the
document as one run; equal tests and repeated rows are each reported; null ids are carried along; other columns are
left aside; an empty table on either side gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import LOWER, mixed, parts, pieces, prefix_sums, span_hashes, text_bytes, word_hashes, words
from millrace.llm.common import Shared

SEED = 5
LEAST = 3
COVERAGE = 0.6
BLOCK_WORDS = 2_000_000
_FILTER_BITS = 22
_STEP = np.uint64(0x9E3779B97F4A7C15)

#: Bytes that count at the end of a word: letters, digits and all of other scripts.
_SOLID = np.zeros(256, bool)
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _SOLID[_low:_high] = True


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word that has a letter or digit, and for each text the number of its first word."""
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    place = np.arange(len(data))
    solid = _SOLID[data]
    before = np.maximum.accumulate(np.where(solid, place, -1))  # last solid byte up to here
    after = np.minimum.accumulate(np.where(solid, place, len(data))[::-1])[::-1]
    low, high = after[starts], before[ends - 1] + 1
    real = low < high
    counts = np.concatenate([[0], np.cumsum(real)])
    return word_hashes(data, low[real], high[real]), counts[first]


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """Running hashes of all windows of that many words; an empty array if there are none."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out *= _STEP
        out += hashes[k : k + n]
    return mixed(out)


def _free(taken: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The starts of windows that lie inside of the text and hold no marked word."""
    starts = starts[starts + length < len(taken) + 1]
    marked = np.r_[0, np.cumsum(taken)]
    return starts[marked[starts + length] == marked[starts]]


def tile(doc: np.ndarray, test: np.ndarray, least: int = LEAST) -> int:
    """Words of the test that greedy string tiling marks; both are arrays of word hashes.

    Running Karp-Rabin: the hashes of all unmarked windows of the search length are compared. The length is the
    largest at which any agree, found by bisection, as parts of a common run are common too; all that agree are marked,
    leftmost in the document first, and the length falls. Windows can only start where one of ``least`` words agrees.
    """
    if len(doc) < least or len(test) < least or least < 1:
        return 0
    sums_a, sums_b = prefix_sums(doc), prefix_sums(test)
    places_b = np.arange(len(test) - least + 1)
    heads = span_hashes(sums_a, np.arange(len(doc) - least + 1), np.arange(least, len(doc) + 1))
    places_a = np.flatnonzero(np.isin(heads, span_hashes(sums_b, places_b, places_b + least)))
    taken_a, taken_b = np.zeros(len(doc), bool), np.zeros(len(test), bool)

    def common(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Unmarked windows of the document and of the test that agree, with their hashes."""
        a, b = _free(taken_a, places_a, length), _free(taken_b, places_b, length)
        of_a, of_b = span_hashes(sums_a, a, a + length), span_hashes(sums_b, b, b + length)
        some_a, some_b = np.isin(of_a, of_b), np.isin(of_b, of_a)
        return a[some_a], of_a[some_a], b[some_b], of_b[some_b]

    top = min(len(doc), len(test))
    while top >= least:
        low, high = least - 1, top  # some windows agree at low, none above high
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if len(common(middle)[0]) else (low, middle - 1)
        if low < least:
            break
        a, of_a, b, of_b = common(low)
        queues: dict[int, list[int]] = {}
        for h, j in zip(of_b[::-1].tolist(), b[::-1].tolist(), strict=True):
            queues.setdefault(h, []).append(j)
        at, left = 0, len(queues)
        for h, i in zip(of_a.tolist(), a.tolist(), strict=True):
            if i < at or not queues[h]:
                continue
            queue = queues[h]
            while queue and (taken_b[queue[-1] : queue[-1] + low].any() or not np.array_equal(doc[i : i + low], test[queue[-1] : queue[-1] + low])):
                queue.pop()  # a part of it is marked by now
            if queue:
                at, j = i + low, queue.pop()
                taken_a[i:at] = taken_b[j : j + low] = True
            left -= not queue
            if not left:
                break
        top = low - 1
    return int(taken_b.sum())


class Block:
    """Part of the benchmark, ready to be looked up."""

    def __init__(self, rows: list[tuple], seed: int):
        self.ids = [item for item, _ in rows]
        raw = [text.encode() for _, text in rows]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)]).astype(np.int64)
        hashes, first = tokens(np.frombuffer(b"".join(raw), np.uint8), offsets)
        self.words = [hashes[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        seeds = [(windows(w, min(seed, len(w))), len(w)) for w in self.words if len(w)]
        self.lengths = sorted({min(seed, n) for _, n in seeds})
        self.tables = {}
        for length in self.lengths:
            of = [(h, i) for i, w in enumerate(self.words) if len(w) and min(seed, len(w)) == length for h in windows(w, length).tolist()]
            keys = np.array([h for h, _ in of], np.uint64)
            order = np.argsort(keys, kind="stable")
            marks = np.zeros(1 << _FILTER_BITS, bool)
            marks[keys >> np.uint64(64 - _FILTER_BITS)] = True
            self.tables[length] = (keys[order], np.array([i for _, i in of])[order], marks)

    def candidates(self, hashes: np.ndarray, first: np.ndarray) -> set[tuple[int, int]]:
        """(text, test) pairs that share a seed."""
        found = set()
        for length, (keys, items, marks) in self.tables.items():
            heads = windows(hashes, length)
            at = np.flatnonzero(marks[heads >> np.uint64(64 - _FILTER_BITS)])
            text = np.searchsorted(first, at, "right") - 1
            inside = at + length <= first[text + 1]
            at, text = at[inside], text[inside]
            low, high = np.searchsorted(keys, heads[at]), np.searchsorted(keys, heads[at], "right")
            for t, a, b in zip(text.tolist(), low.tolist(), high.tolist(), strict=True):
                if a < b:
                    found.update((t, int(i)) for i in items[a:b])
        return found


def _blocks(benchmark: DataFrame, most: int) -> Iterator[list[tuple]]:
    """Tests in blocks of so many words; the driver holds one at a time. At least one block, if an empty one."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").filter("text is not null").orderBy("item_id", "text").toLocalIterator():
        n = row["text"].count(" ") + 1
        if block and size + n > most:
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += n
    yield block


def _matches(block: Block, batch: pa.RecordBatch, least: int, coverage: float) -> list[tuple]:
    """(row, item, words marked, words, coverage) of all pairs of a batch and a block that reach the coverage."""
    data, offsets = text_bytes(batch.column("text"))
    found = []
    for low, high in pieces(offsets):
        hashes, first = tokens(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        for t, i in sorted(block.candidates(hashes, first)):
            test = block.words[i]
            matched = tile(hashes[first[t] : first[t + 1]], test, min(least, len(test)))
            if matched >= coverage * len(test):
                found.append((low + t, block.ids[i], matched, len(test), matched / len(test)))
    return found


def find_tests(docs: DataFrame, benchmark: DataFrame, columns: list[str], seed: int = SEED, least: int = LEAST, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``columns``, item_id, matched (words of the test marked), item_words and coverage, for each pair found."""
    kept = docs.select(*columns, "text")
    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "text")
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"{head}, item_id {item_type}, matched long, item_words long, coverage double"
    out = None
    for rows in _blocks(benchmark, block_words):
        shared = Shared(docs.sparkSession, Block(rows, seed))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.get()
            for batch in batches:
                found = _matches(block, batch, least, coverage)
                if found:
                    at = pa.array([f[0] for f in found])
                    arrays = [batch.column(c).take(at) for c in columns]
                    arrays += [pa.array([f[1] for f in found], _arrow(item_type)), *[pa.array([f[k] for f in found]) for k in (2, 3, 4)]]
                    yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "item_id", "matched", "item_words", "coverage"])

        part = kept.mapInArrow(work, schema)
        out = part if out is None else out.unionByName(part)
    return out


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """One row per document that holds tests: doc_id, n_items, worst coverage, the items by id."""
    pairs = find_tests(docs, benchmark, ["doc_id"], **settings)
    return pairs.groupBy("doc_id").agg(
        F.countDistinct("item_id").alias("n_items"),
        F.max("coverage").alias("coverage"),
        F.array_sort(F.collect_set("item_id")).alias("items"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, least: int = LEAST, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that hold no test, with all their columns; each block of the benchmark filters in the task of the document."""
    out = docs
    for rows in _blocks(benchmark, block_words):
        shared = Shared(docs.sparkSession, Block(rows, seed))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.get()
            for batch in (part for whole in batches for part in parts(whole)):
                stays = np.ones(batch.num_rows, bool)
                stays[[f[0] for f in _matches(block, batch, least, coverage)]] = False
                yield batch.filter(pa.array(stays))

        out = out.mapInArrow(work, docs.schema)
    return out
