"""Forests of tables with few features and many rows, which a model of ``pyspark.ml`` would pass over once a level.

The thresholds of a feature, ``BINS`` - 1 at most, cut the rows into cells, and no split of a tree ever parts a cell. So one
pass draws for each row how often each tree takes it (Poisson of mean 1, as in ``pyspark.ml``) and adds up its label in its cell; a
tree then grows from its cells alone, all trees at the same time. There are ``BINS`` to the power of the features cells
at most, however many rows. The nodes go where ``pyspark.ml`` stores those of a forest, so that a model of its own is loaded of them.

Splits, gains, leaves and their merging are those of ``pyspark.ml``; its thresholds come from a sample of the rows, these from
quantiles of all of them.

Functions that run inside tasks are sent to the executors by value, so these need not have the library installed.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32
#: Cells up to which a tree grows in one task.
MOST_CELLS = 2**16
#: Rows whose draws are held at once, and how far a quantile may lie from its rank.
AT_ONCE, ERROR = 8_192, 0.001
#: A child below this impurity is a leaf.
EVEN = 2.0**-52

NODES = "arbol int, nodo int, izquierdo int, derecho int, caracteristica int, umbral double, ganancia double, impureza double, prediccion double, sumas array<double>"


def fits(features: Sequence[str]) -> bool:
    return BINS ** len(features) <= MOST_CELLS


def thresholds(rows: DataFrame, features: Sequence[str]) -> list[list[float]]:
    """Between all values of a feature if there are ``BINS`` or fewer, else at its quantiles."""
    many = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in features]).first()
    out = []
    for c in features:
        few = rows.select(F.col(c).cast("double")).distinct().limit(BINS + 1).collect() if many[c] <= 2 * BINS else []
        if 0 < len(few) <= BINS:
            values = np.sort([v[0] for v in few])
            out.append(((values[1:] + values[:-1]) / 2).tolist())
        else:
            out.append(sorted(set(rows.approxQuantile(c, [i / BINS for i in range(1, BINS)], ERROR))))
    return out


def _sums(rows: DataFrame, features: Sequence[str], cuts: list[list[float]], classes: int, trees: int, seed: int) -> DataFrame:
    """Training rows to (tree, part, cells, sums): what each tree takes of the cells of a part of the rows.

    Sums are, of a label without classes, how many rows, their labels and the squares of these, else how many rows of each class.
    """
    width = classes or 3

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rng = np.random.default_rng([seed, part])
        total = np.zeros((BINS ** len(features), trees, width))
        for batch in (b.slice(low, AT_ONCE) for b in batches for low in range(0, b.num_rows, AT_ONCE)):
            values = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", *features)]
            if any(np.isnan(v).any() for v in values):
                raise ValueError("a label or feature of a training row is null")
            bins = [np.searchsorted(t, x, "left") for t, x in zip(cuts, values[1:], strict=True)]
            cell, label = np.ravel_multi_index(bins, [BINS] * len(features)), values[0]
            order = np.argsort(cell, kind="stable")
            cell, label = cell[order], label[order]
            first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            drawn = rng.poisson(1.0, (len(cell), trees)).astype(np.float64)
            for k in range(width):
                of = (label == k) if classes else label**k
                total[cell[first], :, k] += np.add.reduceat(drawn * of[:, None], first, axis=0)
        for tree in range(trees):
            some = np.flatnonzero(total[:, tree].any(axis=1))
            if len(some):
                yield pa.RecordBatch.from_pydict(
                    {"tree": [tree], "part": [part], "cells": [some.tobytes()], "sums": [total[some, tree].tobytes()]}
                )

    some = rows.select(*[F.col(c).cast("double").alias(c) for c in ("label", *features)])
    # each task sends all cells of all trees
    few = some.coalesce(max(1, rows.sparkSession.sparkContext.defaultParallelism))
    return few.mapInArrow(work, "tree long, part long, cells binary, sums binary")


def _impurity(sums: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and impurity of sums in the last axis; none without rows."""
    n = sums.sum(axis=-1) if classes else sums[..., 0]
    some = np.where(n > 0, n, 1)
    if classes:
        return n, np.where(n > 0, 1 - ((sums / some[..., None]) ** 2).sum(axis=-1), 0)
    return n, np.where(n > 0, (sums[..., 2] - sums[..., 1] ** 2 / some) / some, 0)


def grown(
    cells: np.ndarray, sums: np.ndarray, cuts: list[list[float]], classes: int, subset: int, depth: int, least: int, rng: np.random.Generator
) -> list[tuple]:
    """One tree of its cells: rows of ``NODES`` without ``arbol``, the children of a node after it."""
    p, width = len(cuts), sums.shape[1]
    bins = np.stack(np.unravel_index(cells, [BINS] * p))
    at = np.zeros(len(cells), np.int64)  # open node of each cell, -1 if it is in a leaf
    held, level = [[sums.sum(axis=0), -1, -1, -1, 0.0, -1.0]], [0]  # sums, children, feature, threshold, gain
    for _ in range(depth):
        place = np.full(len(held), -1)
        place[level] = np.arange(len(level))
        some = np.flatnonzero(at >= 0)
        own = place[at[some]]
        counted = np.empty((len(level), p, BINS, width))
        for f in range(p):
            slot = own * BINS + bins[f][some]
            for k in range(width):
                counted[:, f, :, k] = np.bincount(slot, sums[some, k], len(level) * BINS).reshape(-1, BINS)
        left = counted.cumsum(axis=2)[:, :, :-1]
        whole = np.array([held[node][0] for node in level])
        right = whole[:, None, None] - left
        (n, impure), (nl, il), (nr, ir) = (_impurity(x, classes) for x in (whole, left, right))
        gain = impure[:, None, None] - (nl * il + nr * ir) / n[:, None, None]
        gain = np.where((nl >= least) & (nr >= least), gain, -1.0)
        chosen = rng.random((len(level), p)).argsort(axis=1).argsort(axis=1) < subset
        gain = np.where(chosen[:, :, None], gain, -1.0)
        for f in range(p):
            gain[:, f, len(cuts[f]) :] = -1.0
        best = gain.reshape(len(level), -1).argmax(axis=1)
        following, moved = [], np.full((len(held), 2), -1)
        feature, limit = np.zeros((2, len(held)), np.int64)
        for i, node in enumerate(level):
            f, b = divmod(int(best[i]), BINS - 1)
            if gain[i, f, b] <= 0:
                continue
            held[node][1:] = [len(held), len(held) + 1, f, cuts[f][b], float(gain[i, f, b])]
            feature[node], limit[node] = f, b
            for side, (own_sums, uneven) in enumerate(((left, il), (right, ir))):
                if uneven[i, f, b] >= EVEN:
                    moved[node, side] = len(held)
                    following.append(len(held))
                held.append([own_sums[i, f, b], -1, -1, -1, 0.0, -1.0])
        to_right = (bins[feature[at[some]], some] > limit[at[some]]).astype(np.int64)
        at[some] = moved[at[some], to_right]
        level = following
        if not level:
            break
    said = [float(s[0].argmax()) if classes else float(s[0][1] / s[0][0]) for s in held]
    # children that are leaves and say the same make one leaf
    for node in range(len(held) - 1, -1, -1):
        a, b = held[node][1:3]
        if a >= 0 and held[a][1] < 0 and held[b][1] < 0 and said[a] == said[b]:
            held[node][1:] = [-1, -1, -1, 0.0, -1.0]
    order, queue = [], [0]
    while queue:
        node = queue.pop()
        order.append(node)
        if held[node][1] >= 0:
            queue += [held[node][2], held[node][1]]
    number = {node: i for i, node in enumerate(order)}
    return [
        (i, number.get(held[o][1], -1), number.get(held[o][2], -1), *held[o][3:], float(_impurity(held[o][0], classes)[1]), said[o], held[o][0].tolist())
        for i, o in enumerate(order)
    ]


def nodes(
    rows: DataFrame, features: Sequence[str], classes: int, trees: int, subset: int, depth: int, least: int, seed: int
) -> DataFrame:
    """Rows (label, features) to the nodes of a forest; ``classes`` is 0 for a regression."""
    cuts = thresholds(rows, features)
    width = classes or 3

    def grow(parts: pd.DataFrame) -> pd.DataFrame:
        parts, tree = parts.sort_values("part"), int(parts["tree"].iloc[0])
        cells = np.concatenate([np.frombuffer(c, np.int64) for c in parts["cells"]])
        taken = np.concatenate([np.frombuffer(s, np.float64) for s in parts["sums"]]).reshape(-1, width)
        cells, of = np.unique(cells, return_inverse=True)
        total = np.stack([np.bincount(of, taken[:, k], len(cells)) for k in range(width)], axis=1)
        found = grown(cells, total, cuts, classes, subset, depth, least, np.random.default_rng([seed, 1 << 32, tree]))
        return pd.DataFrame([(tree, *node) for node in found], columns=[c.split()[0] for c in NODES.split(", ")])

    return _sums(rows, features, cuts, classes, trees, seed).groupBy("tree").applyInPandas(grow, NODES)
