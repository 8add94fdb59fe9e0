"""Operator 7: embedding near-duplicates, exact pairs by dual traversal of cover trees.

Unit vectors at cosine c lie sqrt(2 - 2c) apart, so a threshold on the cosine is a radius. Vectors of a label are dealt
into blocks of about ``BLOCK``: by the nearest of up to ``PIVOTS`` pivots, large cells further by a hash. A pair of
blocks whose covering balls stay apart is never formed. In the task of a pair of blocks each block becomes a cover tree:
nested levels with halving radii, every node with the true radius that covers what is below it. The traversal walks
both trees at once, drops node pairs that lie farther apart than threshold and both radii, and ends in exact cosines.

Equal vectors of a label become one row with a count first. A task returns links counted per vector and a forest that
connects what it found, never all pairs, so a large group of near copies costs its rows, not their square, beyond the task.

Defined cases: a null label, a null, empty or zero vector and one with null or non-finite components links with nothing;
vectors of different lengths do not link; equal vectors link with each other; rows that repeat a vec_id count
each; a null vec_id never becomes a component's id unless all its ids are null; other columns are left aside; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import written
from millrace.llm.components import connected

COSINE = 0.98
BLOCK = 2_000
PIVOTS = 16
LEAF = 16
#: Slack of the bounds, far above rounding.
SLACK = 1e-9


class Tree:
    """Cover tree over unit vectors: per node its centre, covering radius, children, or the points of a leaf."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.centre, self.radius, self.children, self.points = [], [], [], []
        self.root = self._grow(0, np.arange(len(x)), 2.0)

    def _distance(self, centre: int, points: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2 - 2 * (self.x[points] @ self.x[centre])))

    def _grow(self, centre: int, points: np.ndarray, radius: float) -> int:
        node = len(self.centre)
        self.centre.append(centre)
        self.radius.append(float(self._distance(centre, points).max()) + SLACK)
        self.children.append(np.zeros(0, np.int64))
        self.points.append(points)
        if len(points) <= LEAF or radius < 0.05:
            return node
        # a net of half the radius that starts with the parent's own centre
        radius /= 2
        left, parts, chosen = points, [], centre
        while len(left):
            near = self._distance(chosen, left) <= radius
            near[left == chosen] = True
            parts.append((chosen, left[near]))
            left = left[~near]
            chosen = left[0] if len(left) else -1
        if len(parts) == 1:  # nothing to split at this level: go to the next one without a node of its own
            self.centre.pop(), self.radius.pop(), self.children.pop(), self.points.pop()
            return self._grow(centre, points, radius)
        self.children[node] = np.array([self._grow(c, p, radius) for c, p in parts])
        return node


def linked(a: Tree, b: Tree, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index arrays (i in a, j in b) of all pairs with that cosine or more, by traversing both trees."""
    reach = float(np.sqrt(2 - 2 * cosine)) + SLACK
    centre = [np.array(t.centre) for t in (a, b)]
    radius = [np.array(t.radius) for t in (a, b)]
    stack = [(np.array([a.root]), np.array([b.root]))]
    while stack:
        left, right = stack.pop()
        if len(left) > 512:
            stack += [(left[:512], right), (left[512:], right)]
            continue
        gap = np.sqrt(np.maximum(0.0, 2 - 2 * (a.x[centre[0][left]] @ b.x[centre[1][right]].T)))
        near = gap <= reach + radius[0][left][:, None] + radius[1][right][None]
        for n, row in zip(left[near.any(axis=1)].tolist(), near[near.any(axis=1)], strict=True):
            others = right[row]
            deep = np.array([len(b.children[m]) > 0 for m in others], bool)
            if len(a.children[n]):
                if deep.any():
                    stack.append((a.children[n], np.concatenate([b.children[m] for m in others[deep]])))
                if (~deep).any():
                    stack.append((a.children[n], others[~deep]))
            else:
                if deep.any():
                    stack.append((np.array([n]), np.concatenate([b.children[m] for m in others[deep]])))
                if (~deep).any():
                    i, j = a.points[n], np.concatenate([b.points[m] for m in others[~deep]])
                    at, to = np.nonzero(a.x[i] @ b.x[j].T >= cosine)
                    if len(at):
                        yield i[at], j[to]


def _pair_links(rows: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links counted per vector, as (node, null, count), and a star for each group they connect, as (node, root, 0)."""
    x = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    first = rows["first"].to_numpy(bool)
    ids, copies = rows["node"].to_numpy(np.int64), rows["copies"].to_numpy(np.int64)
    own = bool(rows["own"].iloc[0])
    low = np.flatnonzero(first)
    high = low if own else np.flatnonzero(~first)
    if not len(low) or not len(high):
        return pd.DataFrame({"u": [], "v": [], "links": []})
    a = Tree(x[low])
    b = a if own else Tree(x[high])
    counts, root = np.zeros(len(x), np.int64), np.arange(len(x))
    for i, j in linked(a, b, cosine):
        i, j = low[i], high[j]
        if own:
            i, j = i[i != j], j[i != j]
        np.add.at(counts, i, copies[j])
        if not own:
            np.add.at(counts, j, copies[i])
        while True:
            u, v = root[i], root[j]
            apart = u != v
            if not apart.any():
                break
            np.minimum.at(root, np.maximum(u, v)[apart], np.minimum(u, v)[apart])
            while (root != root[root]).any():
                root = root[root]
    some, joined = np.flatnonzero(counts), np.flatnonzero(root != np.arange(len(x)))
    return pd.DataFrame(
        {
            "u": np.concatenate([ids[some], ids[joined]]),
            "v": pd.array([None] * len(some) + ids[root[joined]].tolist(), dtype="Int64"),
            "links": np.concatenate([counts[some], np.zeros(len(joined), np.int64)]),
        }
    )


def _cosine(a: F.Column, b: F.Column) -> F.Column:
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, p: s + p)

    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def _blocks(reps: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Members (label, block, node, embedding, copies) and the pairs of blocks whose balls come near each other."""
    wanted = F.least(F.lit(PIVOTS), F.ceil(F.col("n") / block)).cast("int")
    sizes = reps.groupBy("label", "dims").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("label", "dims").orderBy("node"))
    first = reps.select("label", "dims", "node", "embedding", rank.alias("rank")).filter(F.col("rank") <= PIVOTS)
    pivots = first.join(sizes, ["label", "dims"]).filter(F.col("rank") <= wanted)
    pivots = pivots.groupBy("label", "dims").agg(F.array_sort(F.collect_list(F.struct("rank", "embedding"))).alias("pivots"))
    dealt = reps.join(pivots, ["label", "dims"])
    near = F.transform("pivots", lambda p: F.struct(_cosine(p["embedding"], F.col("embedding")).alias("cos"), (-p["rank"]).alias("cell"), p["embedding"].alias("pivot")))
    dealt = dealt.withColumn("best", F.when(F.size("pivots") == 1, near[0]).otherwise(F.array_max(near)))
    dealt = dealt.select("label", "dims", "node", "embedding", "copies", (-F.col("best.cell")).alias("cell"), F.col("best.cos").alias("cos"), F.col("best.pivot").alias("pivot"))
    cells = dealt.groupBy("label", "dims", "cell").agg(F.ceil(F.count("*") / block).alias("parts"))
    members = dealt.join(cells, ["label", "dims", "cell"])
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    members = written(members.select("label", "dims", F.concat_ws("/", "cell", part).alias("block"), "node", "embedding", "copies", "cos", "pivot"), "cover-members")
    ball = F.max(F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("cos"))))
    balls = written(members.groupBy("label", "dims", "block").agg(ball.alias("radius"), F.first("pivot").alias("pivot")), "cover-balls")
    other = balls.select("label", "dims", F.col("block").alias("block2"), F.col("radius").alias("radius2"), F.col("pivot").alias("pivot2"))
    pairs = balls.join(other, ["label", "dims"]).filter("block <= block2")
    gap = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * _cosine(F.col("pivot"), F.col("pivot2"))))
    return members, pairs.withColumn("gap", gap)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(vec_id, label, embedding) to vec_id, n_links, component_id, kept."""
    e = F.col("embedding")
    limit = F.lit(float("inf"))
    sound = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < limit)) & F.exists(e, lambda v: v != 0)
    usable = F.coalesce(F.col("label").isNotNull() & e.isNotNull() & sound, F.lit(False))
    # 128 bits say which vectors are equal, label and components; the equal ones are one node
    marks = [F.when(usable, F.xxhash64(F.lit(i), "label", e)).alias(f"mark{i}") for i in (0, 1)]
    rows = written(vectors.select("vec_id", "label", e.alias("embedding"), *marks), "cover-rows")
    used = rows.filter("mark0 is not null")
    reps = used.groupBy("mark0", "mark1").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    reps = written(reps.withColumn("dims", F.size("embedding")).withColumn("node", F.monotonically_increasing_id()), "cover-reps")

    members, pairs = _blocks(reps, block)
    reach = float(np.sqrt(2 - 2 * cosine)) + 1e-6
    pairs = pairs.filter(F.col("gap") <= F.col("radius") + F.col("radius2") + reach).select("label", "dims", "block", "block2", (F.col("block") == F.col("block2")).alias("own"))
    sides = pairs.select("*", F.explode(F.when(F.col("own"), F.array(F.lit(True))).otherwise(F.array(F.lit(True), F.lit(False)))).alias("first"))
    sides = sides.select("label", "dims", F.when(F.col("first"), F.col("block")).otherwise(F.col("block2")).alias("side"), F.concat_ws("|", "block", "block2").alias("pair"), "own", "first")
    side = members.select("label", "dims", F.col("block").alias("side"), "node", "embedding", "copies")
    dealt = side.join(sides, ["label", "dims", "side"]).select("label", "dims", "pair", "own", "first", "node", "copies", "embedding")

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        return _pair_links(rows, cosine)

    found = written(dealt.groupBy("label", "dims", "pair").applyInPandas(work, "u long, v long, links long"), "cover-links")
    counts = found.filter("v is null").groupBy("u").agg(F.sum("links").alias("links"))
    roots = connected(found.filter("v is not null").select("u", "v"), "cover-components")
    named = reps.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    info = named.join(least, "root").join(counts, F.col("node") == F.col("u"), "left")
    info = info.select("mark0", "mark1", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = rows.join(info, ["mark0", "mark1"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
