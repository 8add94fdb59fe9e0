"""Ordered work without a single task: range slices with a carried prefix.

A window over a whole table, or over a key that holds a third of it, would run in one task.
Here the order is first cut into slices of about ``ROWS_PER_SLICE`` rows, ``TARGET`` at least.
The cut points are values of the order key picked by their hash, so the choice is repeatable
when a lost task reruns, follows the data and works for every sortable type. Windows then run
per slice, and what earlier slices pass on is a table of at most one row per key and slice.
Results are exact; the cut points decide only where the work is split. The key that is cut
has a tie-breaker, so equal order values do not keep a slice together.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import settle

TARGET = 128
ROWS_PER_SLICE = 1_000_000
MOST = 2**16  # beyond 65 billion rows the slices grow instead of the list of cut points
STEPS = 17  # the descent tells twice as many slices apart as there can be expected


def tie_breaker(df: DataFrame) -> Column:
    """Hash of the whole row: rows of equal order go apart, equal rows stay together."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)])


def cuts_below(cuts: Column, key: Column, steps: int) -> Column:
    """How many of the ascending cut points, fewer than 2**steps, lie below the key.

    Binary search as one fold: steps as columns of their own would be inlined into each other.
    """
    return F.aggregate(
        F.array(*[F.lit(2**i) for i in range(steps - 1, -1, -1)]),
        F.lit(0),
        lambda at, step: at + F.when(F.try_element_at(cuts, at + step) < key, step).otherwise(F.lit(0)),
    )


def with_slice(df: DataFrame, order_key: Column, target: int = TARGET, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Add ``__order`` (the key) and ``__slice`` (number of cut points below it)."""
    keyed = df.withColumn("__order", order_key)
    rows = keyed.agg(F.count(F.lit(1))).scalar()
    wanted = F.least(F.lit(MOST), F.greatest(F.lit(target), F.ceil(rows / F.lit(rows_per_slice))))
    every = F.greatest(F.lit(1), F.floor(rows / wanted))
    cuts = (
        keyed.where(F.pmod(F.xxhash64("__order"), every) == 0)
        .agg(F.sort_array(F.collect_set("__order")))
        .scalar()
    )
    keyed = keyed.withColumn("__cuts", cuts)
    keyed = keyed.withColumn("__slice", cuts_below(F.col("__cuts"), F.col("__order"), STEPS))
    return keyed.drop("__cuts")


def _carry_join(df: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach the prefix of each (keys, slice). Without keys the rows already lie by slice."""
    right = carried.select(*[F.col(k).alias(f"__r_{k}") for k in keys], F.col("__slice").alias("__r_slice"), "__carry")
    match = F.col("__slice") == F.col("__r_slice")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return df.join(right, match, "left").drop("__r_slice", *[f"__r_{k}" for k in keys])


def _before(keys: Sequence[str]):
    """Earlier slices of the same key; each key has at most a row per slice here."""
    return (
        Window.partitionBy(*(keys or [F.lit(0)]))
        .orderBy("__slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def rank_within(
    df: DataFrame,
    order: Sequence[Column],
    out: str,
    keys: Sequence[str] = (),
    dense: bool = False,
    small: bool = False,
) -> DataFrame:
    """Rank from 1 by the ascending order columns, per key or over the whole table.

    ``dense`` gives equal order values one rank; otherwise the order must be total. ``small``
    says that the table was found to be small: it then takes one plain window.
    """
    if small:
        window = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*order)
        rank = F.dense_rank() if dense else F.row_number()
        return df.withColumn(out, rank.over(window).cast("long"))
    if dense:
        return _dense_rank(df, order, out, keys)
    parts = [*[c.alias(f"o{i}") for i, c in enumerate(order)], *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]]
    sliced = with_slice(df, F.struct(*parts))
    window = Window.partitionBy(*keys, "__slice").orderBy(*order)
    ranked = sliced.drop("__order").withColumn("__local", F.row_number().over(window))
    last = ranked.groupBy(*keys, "__slice").agg(F.max("__local").alias("__last"))
    carried = last.withColumn("__carry", F.sum("__last").over(_before(keys)))
    joined = _carry_join(ranked, carried, keys)
    rank = F.col("__local") + F.coalesce(F.col("__carry"), F.lit(0))
    return joined.withColumn(out, rank.cast("long")).drop("__local", "__carry", "__slice")


def _dense_rank(df: DataFrame, order: Sequence[Column], out: str, keys: Sequence[str]) -> DataFrame:
    """Number the distinct order values, which have no ties, and join the numbers to the rows."""
    names = [f"__v{i}" for i in range(len(order))]
    valued = df.withColumns(dict(zip(names, order, strict=True)))
    values = valued.select(*keys, *names).distinct()
    ranked = rank_within(values, [F.col(n) for n in names], out, keys)
    right = ranked.select(*[F.col(c).alias(f"__r_{c}") for c in [*keys, *names]], out)
    match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in [*keys, *names]])
    return valued.join(right, match).select(*[F.col(f"`{c}`") for c in df.columns], out)


def _filled(df: DataFrame, columns: Sequence[str], window) -> DataFrame:
    """One projection, so that an order column that is itself filled still orders by its raw value."""
    return df.withColumns({c: F.last(c, ignorenulls=True).over(window) for c in columns})


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    order: Sequence[Column],
    keys: Sequence[str] = (),
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Replace nulls by the last value above them, per key or over the whole table.

    Rows of equal order are taken in the order of a hash of the row. Keys of up to ``rows_per_slice`` rows take one
    plain window, sorted and streamed by Spark; only keys beyond (at most a key per so many rows of the table) are cut into slices.
    """
    tied = df.withColumn("__tie", tie_breaker(df))
    names = df.columns
    if not keys:
        return _fill_slices(tied, columns, order, (), rows_per_slice).select(*[f"`{c}`" for c in names])
    counts = df.groupBy(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("__n"))
    hot = settle(counts.where(F.col("__n") > rows_per_slice).drop("__n"))
    window = Window.partitionBy(*keys).orderBy(*order, "__tie").rowsBetween(Window.unboundedPreceding, 0)
    if hot.isEmpty():
        return _filled(tied, columns, window).select(*[f"`{c}`" for c in names])
    match = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    calm = _filled(tied.join(hot, match, "left_anti"), columns, window)
    cut = _fill_slices(tied.join(hot, match, "left_semi"), columns, order, keys, rows_per_slice)
    return calm.select(*[f"`{c}`" for c in names]).unionByName(cut.select(*[f"`{c}`" for c in names]))


def _fill_slices(
    tied: DataFrame, columns: Sequence[str], order: Sequence[Column], keys: Sequence[str], rows_per_slice: int
) -> DataFrame:
    key = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col("__tie"))
    sliced = with_slice(tied, key, rows_per_slice=rows_per_slice)
    window = Window.partitionBy(*keys, "__slice").orderBy(*order, "__tie").rowsBetween(Window.unboundedPreceding, 0)
    last = sliced.groupBy(*keys, "__slice").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__order"))).alias(c) for c in columns]
    )
    before = _before(keys)
    carried = last.withColumn(
        "__carry", F.struct(*[F.last(c, ignorenulls=True).over(before).alias(c) for c in columns])
    )
    joined = _carry_join(_filled(sliced, columns, window).drop("__order"), carried, keys)
    return joined.withColumns({c: F.coalesce(F.col(c), F.col("__carry")[c]) for c in columns})
