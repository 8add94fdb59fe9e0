"""Right-closed bands: (low, high] with a label each; values outside are null."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bands:
    edges: tuple[float, ...]
    labels: tuple[str, ...]

    def __post_init__(self):
        if len(self.edges) != len(self.labels) + 1:
            raise ValueError("a band list needs one edge more than labels")
        if list(self.edges) != sorted(set(self.edges)):
            raise ValueError("band edges must increase")


# Edges and labels of the published bands.
AGE_GROUP = Bands((0, 25, 35, 45, 55, 100), ("18-25", "26-35", "36-45", "46-55", "55+"))
SALARY_RANGE = Bands(
    (0, 50_000, 75_000, 100_000, 150_000, math.inf),
    ("<50K", "50K-75K", "75K-100K", "100K-150K", "150K+"),
)
EXPERIENCE = Bands((0, 2, 5, 10, math.inf), ("Junior", "Mid", "Senior", "Expert"))
BI_SALARY = Bands(
    (0, 25_000, 50_000, 75_000, 100_000, math.inf),
    ("<25K", "25K-50K", "50K-75K", "75K-100K", "100K+"),
)
BI_AGE = Bands((0, 25, 30, 35, 45, 100), ("<25", "25-30", "30-35", "35-45", "45+"))


def interval_labels(edges: Sequence[float], include_lowest: bool = False) -> tuple[str, ...]:
    """Labels such as ``(0, 10]`` for edges without names."""
    pairs = list(zip(edges[:-1], edges[1:], strict=True))
    return tuple(
        f"{'[' if include_lowest and i == 0 else '('}{lo:g}, {hi:g}]" for i, (lo, hi) in enumerate(pairs)
    )


def band(c: Column, bands: Bands, include_lowest: bool = False) -> Column:
    above = c >= bands.edges[0] if include_lowest else c > bands.edges[0]
    chain = None
    for high, label in zip(bands.edges[1:], bands.labels, strict=True):
        inside = above & ~F.isnan(c.cast("double")) if math.isinf(high) else above & (c <= high)
        chain = F.when(inside, label) if chain is None else chain.when(inside, label)
    return chain
