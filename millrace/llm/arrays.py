"""Texts of Arrow batches as byte arrays: pieces of bounded size, words, hashes of words.

A null text counts as empty everywhere here. Words are ``[^\\x20\\x09-\\x0D]+`` over UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task works on at once; one longer text makes a piece of its own.
PIECE_BYTES = 1 << 19

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 2**64)
_BYTES = np.random.default_rng(11).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and the n + 1 offsets of the texts."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, starts, data = column.buffers()
    if len(column) == 0 or starts is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(starts, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES):
    """Ranges (first, last + 1) of texts that hold at most ``limit`` bytes together, or one text."""
    n, low = len(offsets) - 1, 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield low, min(high, n)
        low = high


def parts(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch cut into batches of ``pieces`` of that column, without a copy.

    Who hands these on one by one holds the results of one part only, as does the task that takes them; a worker keeps for later
    tasks what it once needed at a time.
    """
    for low, high in pieces(text_bytes(batch.column(column))[1], limit):
        yield batch.slice(low, high - low)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the number of its first word (n + 1 values)."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def powers(n: int, base: int = _MULTIPLIER) -> np.ndarray:
    """The first n powers of an odd number modulo 2**64."""
    up = np.full(n, base, np.uint64)
    up[:1] = 1
    return np.multiply.accumulate(up)


def mixed(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, so that every bit depends on all others."""
    x = values.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """Sums of code times power, for ``span_hashes``."""
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(len(codes)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span: a polynomial of its codes, the same wherever the span stands."""
    return mixed((sums[ends] - sums[starts]) * powers(len(sums), _INVERSE)[starts])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(prefix_sums(_BYTES[data]), starts, ends)


def byte_codes(data: np.ndarray) -> np.ndarray:
    return _BYTES[data]
