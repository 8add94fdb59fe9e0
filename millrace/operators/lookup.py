"""Small tables next to big ones: scalar statistics and joins with a checked broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def scalars(df: DataFrame, **aggregates: Column) -> Column:
    """One-row aggregate as a struct that any projection of the same plan can read.

    It runs as a scalar subquery: partial sums per task, one row in the end, no join. Put it
    into a column before reading several fields, so that the plan holds the subquery once.
    """
    return df.agg(F.struct(*[c.alias(name) for name, c in aggregates.items()]).alias("s")).scalar()


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Whether the table is small, found by reading at most ``max_rows + 1`` of its rows."""
    width = reduce(
        lambda a, b: a + b,
        [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns],
    )
    rows, size = (
        df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width + 16), F.lit(0))).first()
    )
    return rows <= max_rows and size <= max_bytes


def join_lookup(
    df: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    broadcast: bool | None = None,
) -> DataFrame:
    """Left join a table of one row per key.

    ``broadcast`` is True for a table bounded by construction, False where both sides are of
    one size, and None to look at the table's size. What is not broadcast goes through a
    shuffle join, whose hot keys AQE splits.
    """
    renamed = table.select(
        *[F.col(f"`{k}`").alias(f"__{k}") for k in keys],
        *[F.col(f"`{c}`") for c in table.columns if c not in keys],
    )
    matches = [
        F.col(f"`{k}`").eqNullSafe(F.col(f"`__{k}`")) if null_safe else F.col(f"`{k}`") == F.col(f"`__{k}`")
        for k in keys
    ]
    if broadcast is None:
        broadcast = fits_broadcast(table)
    right = F.broadcast(renamed) if broadcast else renamed
    return df.join(right, reduce(lambda a, b: a & b, matches), "left").drop(*[f"__{k}" for k in keys])
