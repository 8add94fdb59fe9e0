"""Exact quantiles with linear interpolation, for tables and groups of any size.

The built-in exact percentile keeps every distinct value of a group in one task. Here a first
scan builds a quantile sketch, whose error bound brackets each wanted rank. The second scan
keeps the values inside the brackets and only counts those between them, before anything is
shuffled. A group of n rows sends about 6n/accuracy values on. Where those are still more than
one task should order, they are cut into cells whose exact counts tell which cells hold the wanted
ranks, and only these are cut again: no window ever sees more than ``limit`` rows of a group. If a
bracket missed its rank after all, the work is done again with wider ones. Tables whose groups are all small need no
sketch: one pass orders their values as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.lookup import fits_broadcast
from millrace.operators.slices import cuts_below
from millrace.session import settle

ACCURACY = 100_000
#: Half the width of a bracket, in sketch errors.
SLACK = 3.0
#: Rows of a group that the last window orders, at most.
LIMIT = 200_000


def _number(column: str) -> Column:
    """The column as double, NaN as null."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value)


def _brackets(
    df: DataFrame, columns: Sequence[str], keys: list[str], probs: Sequence[float], accuracy: int, slack: float = SLACK
) -> DataFrame:
    """(keys…, column, __n, lo0, hi0, lo1, …) of each group and column with values, from one aggregate."""
    width = slack / accuracy
    marks = [m for p in probs for m in (max(0.0, p - width), min(1.0, p + width))]
    sketch = df.groupBy(*keys).agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(_number(c)).alias("__n"),
                F.min(_number(c)).alias("__min"),
                F.max(_number(c)).alias("__max"),
                F.percentile_approx(_number(c), marks, accuracy).alias("__marks"),
            ).alias(f"__s{i}")
            for i, c in enumerate(columns)
        ]
    )
    rows = sketch.select(*keys, F.inline(F.array(*[F.col(f"__s{i}") for i in range(len(columns))]))).where("__n > 0")
    # In a small group the slack is less than one rank: all of its values are candidates.
    small = F.col("__n") <= 2 * accuracy
    ends = []
    for i, p in enumerate(probs):
        low = F.when(small | F.lit(p - width <= 0), F.col("__min")).otherwise(F.col("__marks")[2 * i])
        high = F.when(small | F.lit(p + width >= 1), F.col("__max")).otherwise(F.col("__marks")[2 * i + 1])
        ends += [low.alias(f"lo{i}"), high.alias(f"hi{i}")]
    return rows.select(*keys, "column", "__n", *ends)


def _placed(x: Column, lows: Sequence[Column], highs: Sequence[Column]) -> tuple[Column, Column]:
    """Whether a value is a candidate, and what it is counted under: itself or the last bracket below it."""
    inside = reduce(lambda a, b: a | b, [x.between(low, high) for low, high in zip(lows, highs, strict=True)])
    passed = [F.when(x > high, high) for high in highs]
    below = passed[0] if len(passed) == 1 else F.greatest(*passed)
    return inside, F.when(inside, x).otherwise(below)


def _whole_table(df: DataFrame, bounds: Sequence, probs: Sequence[float]) -> DataFrame:
    """Values of a table without keys: the brackets, one row per column, are literals."""
    entries = []
    for row in bounds:
        lows, highs = ([F.lit(row[f"{end}{i}"]) for i in range(len(probs))] for end in ("lo", "hi"))
        x = _number(row["column"])
        inside, value = _placed(x, lows, highs)
        entry = F.struct(
            F.lit(row["column"]).alias("column"), F.lit(row["__n"]).alias("__n"), inside.alias("__in"), value.alias("__v")
        )
        entries.append(F.when(x.isNotNull(), entry))
    return df.select(F.inline(F.array(*entries))).where(F.col("column").isNotNull())


def _by_group(df: DataFrame, columns: Sequence[str], keys: list[str], brackets: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Values of a table with keys, joined to the brackets of their group."""
    entries = [F.struct(F.lit(c).alias("column"), _number(c).alias("__x")) for c in columns]
    if len(columns) == 1:
        spread = df.select(*keys, F.lit(columns[0]).alias("column"), _number(columns[0]).alias("__x"))
    else:
        spread = df.select(*keys, F.inline(F.array(*entries)))
    tagged = _match(spread.where(F.col("__x").isNotNull()), brackets, [*keys, "column"])
    span = range(len(probs))
    inside, value = _placed(F.col("__x"), [F.col(f"lo{i}") for i in span], [F.col(f"hi{i}") for i in span])
    return tagged.select(*keys, "column", "__n", inside.alias("__in"), value.alias("__v"))


def _small_groups(df: DataFrame, columns: Sequence[str], keys: list[str]) -> DataFrame:
    """Counts of all values of groups that one window may order as they are, with the rows of the group, in one pass."""
    entries = [F.struct(F.lit(c).alias("column"), _number(c).alias("__v")) for c in columns]
    spread = df.select(*keys, F.inline(F.array(*entries))).where(F.col("__v").isNotNull())
    counts = spread.groupBy(*keys, "column", "__v").agg(F.count(F.lit(1)).alias("__c"))
    rows = F.sum("__c").over(Window.partitionBy(*keys, "column"))
    return counts.withColumn("__n", rows).withColumn("__in", F.lit(True))


def _match(df: DataFrame, table: DataFrame, group: list[str]) -> DataFrame:
    """Each row with the row of its group, whose number is looked at."""
    right = table.select(*[F.col(g).alias(f"__g_{g}") for g in group], *[c for c in table.columns if c not in group])
    if fits_broadcast(table):
        right = F.broadcast(right)
    return df.join(right, reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__g_{g}")) for g in group]))


def _positions(probs: Sequence[float]) -> list[Column]:
    return [F.lit(p) * (F.col("__n") - 1) for p in probs]


def _narrowed(counts: DataFrame, group: list[str], probs: Sequence[float], cells: int) -> DataFrame:
    """The same counts with all cells that hold no wanted rank as one row each."""
    marks = [k / cells for k in range(1, cells + 1)]
    cuts = settle(counts.groupBy(*group).agg(F.percentile_approx("__v", marks, 20 * cells).alias("__cuts")))
    # the number of marks below a value; what lies below all brackets has a null and a cell of its own
    celled = _match(counts, cuts, group).withColumn("__cell", cuts_below(F.col("__cuts"), F.col("__v"), cells.bit_length()))
    celled = celled.withColumn("__cell", F.when(F.col("__v").isNull(), -1).otherwise(F.col("__cell")))
    sums = celled.groupBy(*group, "__n", "__cell").agg(F.sum("__c").alias("__c"))
    upto = Window.partitionBy(*group).orderBy("__cell").rowsBetween(Window.unboundedPreceding, 0)
    upper = F.sum("__c").over(upto)
    ranks = [rank for at in _positions(probs) for rank in (F.floor(at), F.ceil(at))]
    held = reduce(lambda a, b: a | b, [(F.col("__upto") > r) & (F.col("__upto") - F.col("__c") <= r) for r in ranks])
    kept = settle(sums.withColumn("__upto", upper).where(held).select(*group, "__cell", F.lit(True).alias("__held")))
    marked = _match(celled.drop(*[f"__g_{g}" for g in group]), kept.groupBy(*group).agg(F.collect_set("__cell").alias("__wanted")), group)
    stays = F.array_contains("__wanted", F.col("__cell")) | F.col("__v").isNull()
    value = F.when(stays, F.col("__v")).otherwise(F.col("__cuts")[F.col("__cell")])
    return (
        marked.select(*group, "__n", (stays & F.col("__in")).alias("__in"), value.alias("__v"), "__c")
        .groupBy(*group, "__n", "__in", "__v")
        .agg(F.sum("__c").alias("__c"))
    )


def _largest(counts: DataFrame, group: list[str]) -> int:
    return counts.groupBy(*group).count().agg(F.max("count")).first()[0] or 0


def _bounded(counts: DataFrame, group: list[str], probs: Sequence[float], limit: int) -> DataFrame:
    """Counts of at most ``limit`` rows a group. A step leaves a sixteenth of the values and a row per cell."""
    cells = max(256, 32 * len(probs))
    limit = max(limit, 8 * cells)
    counts = settle(counts)
    rows = _largest(counts, group)
    while rows > limit:
        counts = settle(_narrowed(counts, group, probs, cells))
        rows, before = _largest(counts, group), rows
        if rows >= before:
            raise RuntimeError(f"{rows} values of a group cannot be narrowed down to {limit}")
    return counts


def _picked(counts: DataFrame, group: list[str], probs: Sequence[float]) -> DataFrame:
    """The entries (upto, value, inside) at the ranks around each wanted position."""
    upto = (
        Window.partitionBy(*group)
        .orderBy(F.col("__v").asc_nulls_first(), F.col("__in").desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = counts.withColumn("__cum", F.sum("__c").over(upto))
    entry = F.struct("__cum", "__v", "__in")
    picks = []
    for i, at in enumerate(_positions(probs)):
        picks.append(F.min(F.when(F.col("__cum") > F.floor(at), entry)).alias(f"__lo{i}"))
        picks.append(F.min(F.when(F.col("__cum") > F.ceil(at), entry)).alias(f"__hi{i}"))
    return ranked.groupBy(*group, "__n").agg(*picks)


def quantile_table(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    keys: Sequence[str] = (),
    accuracy: int = ACCURACY,
    slack: float = SLACK,
    limit: int = LIMIT,
) -> DataFrame:
    """Long table ``keys…, column, n, q`` where ``q`` has one value per probability.

    Nulls (and NaN) are left out; a group without values has no row. The sketch is built when this is called.
    """
    probs, keys = [float(p) for p in probs], list(keys)
    if probs != sorted(probs):
        raise ValueError("probabilities must ascend")
    group, span = [*keys, "column"], range(len(probs))
    if keys:
        largest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        if largest <= min(limit, 2 * accuracy):  # brackets would hold all values of such groups
            return _interpolated(_picked(_small_groups(df, columns, keys), group, probs), group, probs)
    brackets = _brackets(df, columns, keys, probs, accuracy, slack)
    if keys:
        brackets = settle(brackets)
        largest = brackets.agg(F.max("__n")).first()[0] or 0
        values = _by_group(df, columns, keys, brackets, probs)
    else:
        bounds = brackets.collect()  # one row per column
        largest = max((row["__n"] for row in bounds), default=0)
        values = _whole_table(df, bounds, probs) if bounds else brackets.select("column", "__n", F.lit(True).alias("__in"), F.col("lo0").alias("__v"))
    counts = values.groupBy(*group, "__n", "__in", "__v").agg(F.count(F.lit(1)).alias("__c"))
    large = largest > min(limit, 2 * accuracy)
    picked = _picked(_bounded(counts, group, probs, limit) if large else counts, group, probs)
    if large:
        hits = [F.col(f"__{end}{i}")["__in"] for i in span for end in ("lo", "hi")]
        if not picked.where(~reduce(lambda a, b: a & b, hits)).isEmpty():
            return quantile_table(df, columns, probs, keys, accuracy, max(8 * slack, SLACK), limit)
    return _interpolated(picked, group, probs)


def _interpolated(picked: DataFrame, group: list[str], probs: Sequence[float]) -> DataFrame:
    results = []
    for i, at in enumerate(_positions(probs)):
        low, high = F.col(f"__lo{i}")["__v"], F.col(f"__hi{i}")["__v"]
        results.append(low + (high - low) * (at - F.floor(at)))
    return picked.select(*group, F.col("__n").alias("n"), F.array(*results).alias("q"))


def table_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], **options) -> Column:
    """Whole-table quantiles as a struct column: field per input column, array per field, null without values.

    They are worked out when this is called, one row per column, so that no later job looks for them again.
    """
    found = {row["column"]: row["q"] for row in quantile_table(df, columns, probs, **options).collect()}
    return F.struct(
        *[
            (F.array(*[F.lit(q) for q in found[c]]) if c in found else F.lit(None)).cast("array<double>").alias(c)
            for c in columns
        ]
    )


def group_medians(df: DataFrame, column: str, keys: Sequence[str], out: str, **options) -> DataFrame:
    table = quantile_table(df, [column], [0.5], keys, **options)
    return table.select(*keys, F.col("q")[0].alias(out))
