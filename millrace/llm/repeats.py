"""Operator 10: suffix-array deduplication of exact repeats of 100 bytes, over all documents.

Every byte goes that lies in a ``LENGTH``-byte string which also starts earlier: in a document with a smaller id, or
before in the same one. Strings are judged on the input. ``suffixes`` finds the repeated windows; this module brings
texts and windows together.

Equal texts are one text first: only the one with the smallest id is searched, any other of at least LENGTH bytes is
removed whole. Texts travel compressed, twice: to cut the slices of their candidate runs, and to be hashed without
what is removed.

Defined cases: null and empty texts have no bytes and keep the hash of nothing; texts shorter than LENGTH stay whole;
rows that share a doc_id are one document as to what is earlier, so equal rows get equal results and remove nothing from each
other; a null id comes after all others; other columns are left aside; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import byte_codes, pieces, text_bytes
from millrace.llm.common import written
from millrace.llm.suffixes import repeated, runs

LENGTH = 100
GRAM = 24
LAST_ID = 2**63 - 1
#: Windows of a run, at most: a place packs the start of a run and its windows into one number.
MOST = (1 << 20) - 1


def _anchors(texts: DataFrame, length: int) -> DataFrame:
    """(owner, text) to the runs of all texts: (hash, owner, place). A run has fewer windows than a window has bytes."""
    gram = max(1, min(GRAM, length // 2))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            owner = batch.column("owner").to_numpy()
            for low, high in pieces(offsets):
                part = data[offsets[low] : offsets[high]]
                of, start, count, hashes = runs(byte_codes(part), offsets[low : high + 1] - offsets[low], length, gram)
                arrays = [hashes, owner[low:high][of], (start << 20) | count]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["hash", "owner", "place"])

    return texts.mapInArrow(work, "hash long, owner long, place long")


def _packed(texts: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and the text, compressed for its way through a shuffle."""
    head = ", ".join(f"{c} {t}" for c, t in texts.dtypes if c in columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed = pa.array([pack((t or "").encode()) for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], packed], names=[*columns, "packed"])

    return texts.select(*columns, "text").mapInArrow(work, f"{head}, packed binary")


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _slices(rows: DataFrame, length: int) -> DataFrame:
    """(packed, rank, owner, list of runs) to the slices of the runs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("runs")
            ends = np.asarray(found.offsets).astype(np.int64)
            flat = found.values
            hashes, n, place = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("hash", "n", "place"))
            starts, counts = place >> 20, place & MOST
            ranks, owners = batch.column("rank").to_numpy(), batch.column("owner").to_numpy()
            first, cut, at = 0, [], []

            def out(first, last, cut=cut, at=at, hashes=hashes, n=n, starts=starts, ranks=ranks, owners=owners):
                of = np.repeat(np.arange(first, last), np.bincount(np.array([t for t, _ in at], np.int64) - first, minlength=last - first))
                pick = np.array([i for _, i in at], np.int64)
                arrays = [pa.array(v) for v in (hashes[pick], n[pick], ranks[of], starts[pick], owners[of])]
                batch = pa.RecordBatch.from_arrays([*arrays, pa.array(cut, pa.binary())], names=["hash", "n", "rank", "start", "owner", "slice"])
                cut.clear(), at.clear()
                return batch

            size = 0
            for t, packed in enumerate(batch.column("packed").to_pylist()):
                text = _unpack(packed)
                for i in range(ends[t], ends[t + 1]):
                    piece = text[starts[i] : starts[i] + counts[i] + length - 1]
                    if len(piece) >= length:  # else a run of another text with the same hash
                        cut.append(piece)
                        at.append((t, i))
                        size += len(piece)
                if size > 4 << 20:
                    yield out(first, t + 1)
                    first, size = t + 1, 0
            if cut:
                yield out(first, batch.num_rows)

    return rows.select("packed", "rank", "owner", "runs").mapInArrow(work, "hash long, n long, rank long, start long, owner long, slice binary")


def _kept(packed: bytes, spans: list, length: int) -> tuple[int, int, str]:
    """Removed bytes, removed stretches, hash of the rest; ``spans`` are (start, windows) of repeated windows."""
    text = _unpack(packed)
    digest, removed, count, at = hashlib.sha256(), 0, 0, 0
    stretches: list[list[int]] = []
    for start, windows in sorted(spans):
        end = start + windows + length - 1
        if stretches and start <= stretches[-1][1]:
            stretches[-1][1] = max(stretches[-1][1], end)
        else:
            stretches.append([start, end])
    for start, end in stretches:
        digest.update(text[at:start])
        removed, count, at = removed + end - start, count + 1, end
    digest.update(text[at:])
    return removed, count, digest.hexdigest()


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, text) to doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"), F.coalesce("doc_id", F.lit(LAST_ID)).alias("rank"), F.xxhash64(text).alias("owner"))
    # the first of equal texts; md5 tells apart texts of one 64-bit hash
    slim = keyed.select("rank", "owner", F.md5(F.col("text").cast("binary")).alias("digest"))
    first = written(slim.groupBy("owner", "digest").agg(F.min("rank").alias("rank")), "repeats-texts")

    anchors = _anchors(keyed.select("owner", "text"), length)
    again = anchors.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1")
    found = anchors.join(again, "hash").groupBy("hash", "owner", "place").agg(F.max("n").alias("n"))
    per_text = found.groupBy("owner").agg(F.collect_list(F.struct("place", "hash", "n")).alias("runs"))
    wanted = written(per_text.join(first.select("owner", "rank"), "owner"), "repeats-runs")

    packed = _packed(keyed, ["rank", "owner"])
    slices = _slices(packed.join(wanted, ["owner", "rank"]), length)
    marks = repeated(slices, length, 1, later=True)
    spans = written(marks.groupBy("owner").agg(F.collect_list(F.struct("start", "windows")).alias("spans")), "repeats-spans")

    # what happens to a text, by row and without texts, so that many equal ones do not meet in a task
    least = first.select("owner", "digest", F.col("rank").alias("least"))
    copy = F.col("rank") > F.col("least")
    verdicts = slim.distinct().join(least, ["owner", "digest"]).select("owner", "rank", copy.alias("copy"))
    spans = spans.join(first.select("owner", "rank"), "owner")
    verdicts = verdicts.join(spans, ["owner", "rank"], "left")
    rows = _packed(keyed.withColumn("n_bytes", F.octet_length("text").cast("long")), ["doc_id", "rank", "owner", "n_bytes"])
    judged = rows.join(verdicts, ["owner", "rank"])
    gone = F.col("copy") & (F.col("n_bytes") >= length)
    return _finished(judged.select("doc_id", "n_bytes", "packed", "spans", gone.alias("copy")), length)


def _finished(rows: DataFrame, length: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256().hexdigest()
        for batch in batches:
            done = []
            for n, packed, spans, copy in zip(*[batch.column(c).to_pylist() for c in ("n_bytes", "packed", "spans", "copy")], strict=True):
                done.append((n, 1, nothing) if copy else _kept(packed, [(s["start"], s["windows"]) for s in spans or []], length))
            arrays = [batch.column("doc_id"), batch.column("n_bytes"), pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
