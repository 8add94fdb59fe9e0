"""Repeated windows over many sequences, by two-stage suffix sorting: what operators 3 and 10 share.

A window is ``width`` symbols of a sequence (bytes of a text, tokens of a page). Windows that are equal have equal smallest
hashes of the ``gram`` symbols inside, so windows are dealt out by that hash: a stretch of windows with
one place of the smallest hash is a run, and its symbols are a slice. Runs whose hash is seen once hold no repeated window
and go no further. The slices of one hash meet in one task. Equal slices are settled at once; of the different ones a
suffix array is built: only suffixes smaller than their successors are sorted directly, the others are induced by a scan over
the buckets of first symbols, and adjacent suffixes with a common prefix of ``width`` symbols are equal windows.

A hash with more than ``GROUP`` runs (a passage that a third of all texts hold) is not sent to one task: its windows
are grouped one by one, with partial minima before the shuffle and a join that Spark splits where it is skewed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import prefix_sums, span_hashes

#: Runs of one hash that meet in a task, at most.
GROUP = 20_000
#: Windows in one suffix array, about.
WINDOWS = 300_000


def runs(codes: np.ndarray, offsets: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows: sequence, start in it, number of windows, hash. ``codes`` are 64-bit values of symbols."""
    n = len(codes)
    windows = np.maximum(0, np.diff(offsets) - width + 1)
    if not windows.any():
        none = np.zeros(0, np.int64)
        return none, none, none, none
    place = np.arange(n - gram + 1)
    hashes = span_hashes(prefix_sums(codes), place, place + gram)
    bits = np.uint64(max(1, int(n).bit_length()))
    # the hash, and the place in its low bits, so that the leftmost of equal ones is the smallest
    least = (hashes >> bits << bits) | place.astype(np.uint64)
    reach, step = width - gram + 1, 1
    while step * 2 <= reach:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < reach:
        least = np.minimum(least[: len(least) - (reach - step)], least[reach - step :])
    of = np.repeat(np.arange(len(windows)), windows)
    start = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    anchor = (least[offsets[of] + start] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])])
    return of[first], start[first], np.diff(np.r_[first, len(of)]), hashes[anchor[first]].view(np.int64)


def window_rows(codes: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    """The windows at these places as byte strings that compare like the symbols do."""
    ordered = codes if codes.dtype == np.uint8 else codes.astype(f">u{codes.dtype.itemsize}")
    rows = np.ascontiguousarray(sliding_window_view(ordered, width)[at])
    return rows.view(f"S{width * ordered.dtype.itemsize}").reshape(-1)


def two_stage(codes: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """The places ``starts`` in the order of the suffixes there, exact to ``width`` symbols.

    ``codes`` is one text of symbols with at least ``width`` more symbols after the last start.
    """
    n = len(codes)
    step = np.sign(np.diff(codes.astype(np.int64), append=0))
    turn = np.minimum.accumulate(np.where(step != 0, np.arange(n), n - 1)[::-1])[::-1]
    larger = step[turn] < 0  # the suffix is larger than its successor: induced
    wanted = np.zeros(n + 1, bool)
    wanted[starts] = True
    fresh = starts
    while len(fresh):  # an induced suffix needs its successor
        fresh = fresh[larger[fresh]] + 1
        fresh = fresh[(fresh < n - width) & ~wanted[fresh]]
        wanted[fresh] = True
    places = np.flatnonzero(wanted)
    induced = larger.copy()
    induced[~wanted[1:]] = False  # no successor in the text: sorted directly
    direct = places[~induced[places]]
    direct = direct[np.argsort(window_rows(codes, width, direct), kind="stable")]
    heads = codes[direct]
    symbols = np.unique(codes[places])
    low, high = np.searchsorted(heads, symbols), np.searchsorted(heads, symbols, "right")
    waiting: dict[int, list[np.ndarray]] = {}
    out = []

    def scan(found: np.ndarray, symbol: int) -> np.ndarray:
        """Put the predecessors that these suffixes induce into their buckets; return those of the own bucket."""
        before = found[found > 0] - 1
        before = before[wanted[before] & induced[before]]
        head = codes[before]
        same = before[head == symbol]
        others, head = before[head != symbol], head[head != symbol]
        order = np.argsort(head, kind="stable")
        others, head = others[order], head[order]
        cuts = np.flatnonzero(np.r_[True, head[1:] != head[:-1]]) if len(head) else []
        for part, at in zip(np.split(others, cuts[1:]), cuts, strict=True) if len(head) else ():
            waiting.setdefault(int(head[at]), []).append(part)
        return same

    for symbol, a, b in zip(symbols.tolist(), low.tolist(), high.tolist(), strict=True):
        parts = waiting.pop(symbol, [])
        if parts:
            found = np.concatenate(parts)
            while len(found):  # runs of one symbol: the predecessor stands in the same bucket
                out.append(found)
                found = scan(found, symbol)
        if a < b:
            out.append(direct[a:b])
            scan(direct[a:b], symbol)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    chosen = np.zeros(n + 1, bool)
    chosen[starts] = True
    return order[chosen[order]]


def equal_windows(codes: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in suffix order, and for each the number of its class: adjacent ones with ``width`` symbols in common."""
    order = two_stage(codes, starts, width)
    rows = window_rows(codes, width, order)
    fresh = np.r_[True, rows[1:] != rows[:-1]] if len(rows) else np.zeros(0, bool)
    return order, np.cumsum(fresh) - 1


class Finder:
    """Collects groups of slices and marks their repeated windows.

    ``later``: mark windows for which an equal one has a smaller (rank, start); otherwise windows that
    have equal ones of ``owners`` owners, their own among them.
    """

    def __init__(self, width: int, item: int, later: bool, owners: int = 2):
        self.width, self.item, self.later, self.owners = width, item, later, owners
        self.kept: list[tuple] = []
        self.windows = 0
        self.marks: list[tuple[int, int, int]] = []  # owner, first window, windows

    def add(self, rows: list[tuple]) -> None:
        """Rows (slice, rank, start, owner) of one hash."""
        groups: dict[bytes, list[tuple]] = {}
        for text, rank, start, owner in rows:
            groups.setdefault(text, []).append((rank, start, owner))
        for text, members in groups.items():
            count = len(text) // self.item - self.width + 1
            members.sort()
            if self.later:
                self.marks += [(owner, start, count) for rank, start, owner in members if (rank, start) > members[0][:2]]
            elif members[0][0] != members[-1][0] and (self.owners == 2 or len({rank for rank, *_ in members}) >= self.owners):
                self.marks += [(owner, start, count) for _, start, owner in members]
        if len(groups) > 1:
            self.kept += [(text, members) for text, members in groups.items()]
            self.windows += sum(len(text) // self.item - self.width + 1 for text in groups)

    def flush(self) -> None:
        if not self.kept:
            return
        slices = self.kept
        self.kept, self.windows = [], 0
        kind = np.uint8 if self.item == 1 else np.dtype(f">u{self.item}")
        raw = np.frombuffer(b"".join(t for t, _ in slices), kind)
        length = np.array([len(t) // self.item for t, _ in slices])
        codes = raw if self.item == 1 else np.unique(raw, return_inverse=True)[1].astype(np.uint32)
        codes = np.concatenate([codes, np.zeros(2 * self.width, codes.dtype)])
        ends = np.cumsum(length)
        counts = length - self.width + 1
        of = np.repeat(np.arange(len(slices)), counts)
        inside = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = (ends - length)[of] + inside
        order, number = equal_windows(codes, starts, self.width)
        # back from places to windows
        window = np.zeros(len(codes), np.int64)
        window[starts] = np.arange(len(starts))
        window = window[order]
        sizes = np.bincount(number)
        some = sizes[number] > 1
        window, number = window[some], number[some]
        rank = np.array([m[0][0] for _, m in slices], np.int64)
        last = np.array([m[-1][0] for _, m in slices], np.int64)
        begin = np.array([m[0][1] for _, m in slices], np.int64)
        flags = np.zeros(len(starts), bool)
        if self.later:
            # only the earliest member of equal slices can still be the first; the others are marked already
            at = begin[of[window]] + inside[window]
            by = np.lexsort((at, rank[of[window]], number))
            window, number, at = window[by], number[by], at[by]
            head = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]) if len(number) else np.zeros(0, np.int64)
            lead = np.repeat(head, np.diff(np.r_[head, len(number)]))
            r = rank[of[window]]
            flags[window] = (r > r[lead]) | ((r == r[lead]) & (at > at[lead]))
        elif len(window) and self.owners > 2:
            sizes = np.array([len(m) for _, m in slices])
            ranks, at = np.array([r for _, m in slices for r, *_ in m], np.int64), np.cumsum(sizes) - sizes
            many = sizes[of[window]]
            inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            pairs = np.unique(np.stack([np.repeat(number, many), ranks[np.repeat(at[of[window]], many) + inner]]), axis=1)
            flags[window] = (np.bincount(pairs[0]) >= self.owners)[number]
        elif len(window):
            low = np.full(number.max() + 1, np.iinfo(np.int64).max)
            high = np.full(number.max() + 1, np.iinfo(np.int64).min)
            np.minimum.at(low, number, rank[of[window]])
            np.maximum.at(high, number, last[of[window]])
            flags[window] = (low < high)[number]
        edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)) != 0) if flags.any() else np.zeros(0, np.int64)
        bounds = np.cumsum(counts)
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            while a < b:
                s = int(np.searchsorted(bounds, a, "right"))
                stop = min(b, int(bounds[s]))
                members = slices[s][1][:1] if self.later else slices[s][1]
                self.marks += [(owner, start + int(inside[a]), stop - a) for _, start, owner in members]
                a = stop

    def batch(self) -> pa.RecordBatch:
        marks, self.marks = np.array(self.marks, np.int64).reshape(-1, 3), []
        return pa.RecordBatch.from_arrays([pa.array(marks[:, i]) for i in range(3)], names=["owner", "start", "windows"])


def repeated(slices: DataFrame, width: int, item: int, later: bool, owners: int = 2) -> DataFrame:
    """Slices (hash, n, rank, start, owner, slice) to (owner, start, windows): stretches of windows that repeat.

    ``n`` is the number of runs of the hash. Windows are compared within their hash; with ``later`` it must be a function of
    the window. ``rank`` orders owners; equal texts have equal owners and ranks.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, group, last = Finder(width, item, later, owners), [], None
        for batch in batches:
            hashes = batch.column("hash").to_pylist()
            rows = zip(*[batch.column(c).to_pylist() for c in ("slice", "rank", "start", "owner")], strict=True)
            for h, row in zip(hashes, rows, strict=True):
                if h != last:
                    finder.add(group)
                    group, last = [], h
                    if finder.windows > WINDOWS:
                        finder.flush()
                        yield finder.batch()
                group.append(row)
        finder.add(group)
        finder.flush()
        yield finder.batch()

    schema = "owner long, start long, windows long"
    calm = slices.filter(F.col("n") <= GROUP)
    calm = calm.select("hash", "rank", "start", "owner", "slice").repartition("hash").sortWithinPartitions("hash")
    found = calm.mapInArrow(meet, schema)

    # hashes of too many runs: every window for itself
    hot = slices.filter(F.col("n") > GROUP)
    count = (F.length("slice") / item).cast("int") - width + 1
    steps = F.explode(F.sequence(F.lit(0), count - 1)).alias("step")
    windows = hot.select("hash", "rank", "start", "owner", "slice", steps)
    cut = F.substring(F.col("slice"), F.col("step") * item + 1, F.lit(width * item))
    # within their hash, as in a task: it may hold more than the window, like the host; with ``later`` the window gives the hash
    by = ["window"] if later else ["hash", "window"]
    windows = windows.select("hash", "rank", (F.col("start") + F.col("step")).alias("start"), "owner", cut.alias("window")).select(*by, "rank", "start", "owner")
    order = F.struct("rank", "start") if later else F.struct("rank")
    ends = windows.groupBy(*by).agg(F.min(order).alias("low"), F.max(order).alias("high")).filter("low < high")
    if owners > 2:
        ends = windows.groupBy(*by).agg(F.countDistinct("rank").alias("n_owners")).filter(F.col("n_owners") >= owners)
    marked = windows.join(ends, by).filter(order > F.col("low") if later else F.lit(True))
    return found.unionByName(marked.select("owner", F.col("start").cast("long").alias("start"), F.lit(1).cast("long").alias("windows")))
