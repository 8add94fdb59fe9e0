"""Cleaning: duplicates, missing values, text, money, dates, categories, emails, outliers."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.config import Thresholds
from millrace.functions import dates, numbers, text
from millrace.operators.lookup import scalars
from millrace.operators.quantiles import table_quantiles
from millrace.operators.slices import forward_fill
from millrace.session import written

log = logging.getLogger(__name__)

STRATEGIES = ("default", "drop", "mean", "median", "mode", "forward_fill", "zero", "unknown")


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns the table has; the others are logged and passed over."""
    for c in columns:
        if c not in df.columns:
            log.warning("column %s not found", c)
    return [c for c in columns if c in df.columns]


def replace_columns(
    df: DataFrame, new: Mapping[str, Column], held: Mapping[str, Column] | None = None
) -> DataFrame:
    """One projection that swaps columns in place and keeps their order.

    ``held`` are columns the new ones read, such as table statistics, and do not stay.
    """
    columns = [new[c].alias(c) if c in new else F.col(f"`{c}`") for c in df.columns]
    return (df.withColumns(dict(held)) if held else df).select(*columns)


def nan_as_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN of floating columns is a gap like any other: null."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    chosen = [c for c in floating if columns is None or c in columns]
    return replace_columns(df, {c: F.nullif(F.col(f"`{c}`"), F.lit(float("nan"))) for c in chosen}) if chosen else df


# -- duplicates ---------------------------------------------------------------------------


def drop_duplicates(
    df: DataFrame, subset: Sequence[str] | None = None, order_by: Sequence[Column] | None = None
) -> DataFrame:
    """Distinct rows, or the first row per ``subset`` in the given order; nulls are equal.

    Both forms thin the copies out in each task before the shuffle, so a row with very many
    copies sends one row per task.
    """
    if subset is None:
        return df.dropDuplicates()
    if not order_by:
        raise ValueError("the first row of a group needs order_by")
    window = Window.partitionBy(*subset).orderBy(*order_by)
    return df.withColumn("__row", F.row_number().over(window)).where("__row = 1").drop("__row")


def deduplicate_counted(df: DataFrame) -> tuple[DataFrame, int, int]:
    """Distinct rows, written to the shared folder, and how many rows went in and came out.

    The copies are counted by the deduplication itself and stored beside the rows, so the input is not read again to be
    counted, and a task that runs twice counts once.
    """
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__copies"))
    stored = written(groups, "deduplicated")
    total, rows = stored.agg(F.coalesce(F.sum("__copies"), F.lit(0)), F.count(F.lit(1))).first()
    return stored.drop("__copies"), total, rows


def row_digest(df: DataFrame) -> list[Column]:
    """128 bits that equal rows share, as two numbers: what to group by when only the number of copies is asked for.

    Rows of any width travel as 16 bytes. Two different rows of 10 billion share a digest with a chance below 1 to 10^18. Which
    columns are null is part of it, as hashes skip nulls; -0.0 counts as 0.0.
    """
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        columns.append(c + F.lit(0.0).cast(f.dataType) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else c)
    empty = F.concat(F.lit(""), *[F.when(F.col(f"`{c}`").isNull(), F.lit("1")).otherwise(F.lit("0")) for c in df.columns])
    return [F.xxhash64(F.lit(seed), empty, *columns).alias(f"__d{seed}") for seed in (0, 1)]


def distinct_counts(df: DataFrame) -> DataFrame:
    """How often each row occurs, without the rows: ``__copies``. Copies merge in each task before the shuffle."""
    if any("map<" in f.dataType.simpleString() for f in df.schema.fields):
        raise ValueError("maps cannot be compared")
    return df.select(*row_digest(df)).groupBy("__d0", "__d1").agg(F.count(F.lit(1)).alias("__copies"))


def duplicate_counts(df: DataFrame) -> DataFrame:
    """One row: rows in, rows out and the difference of a full-row deduplication."""
    return distinct_counts(df).agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("rows_in"), F.count(F.lit(1)).alias("rows_out")
    ).select("rows_in", "rows_out", (F.col("rows_in") - F.col("rows_out")).alias("removed"))


# -- missing values -----------------------------------------------------------------------


def null_profile(df: DataFrame, max_null_pct: float = Thresholds.max_null_pct) -> DataFrame:
    """Null count and share of every column, from one aggregate."""
    rows = F.count(F.lit(1))
    entries = []
    for c in df.columns:
        nulls = rows - F.count(F.col(f"`{c}`"))
        share = numbers.percent(nulls, rows, None)
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                nulls.alias("null_count"),
                share.alias("null_pct"),
                F.coalesce(share > max_null_pct, F.lit(False)).alias("over_threshold"),
            )
        )
    return df.agg(F.array(*entries).alias("r")).select(F.inline("r"))


def most_frequent(df: DataFrame, column: str) -> Column:
    """Most frequent value as a scalar; the smallest one among equals."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    return counts.orderBy(F.desc("__n"), F.asc(column)).limit(1).select(column).scalar()


def fill_missing(
    df: DataFrame,
    strategy: Mapping[str, str],
    order_by: Sequence[Column] = (),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Apply a strategy per column, in the column order of the table.

    ``drop`` thins the rows that later columns take their statistics from; between drops all
    means and all medians come from one aggregate each.
    """
    for c, s in strategy.items():
        if s not in STRATEGIES:
            raise ValueError(f"unknown strategy {s!r} for {c}")
    df = nan_as_null(df, list(strategy))
    todo: list[str] = []
    for c in df.columns:
        if strategy.get(c) == "drop":
            df = _fill(df, todo, strategy, order_by, keys).where(F.col(f"`{c}`").isNotNull())
            todo = []
        elif c in strategy:
            todo.append(c)
    return _fill(df, todo, strategy, order_by, keys)


def _fill(df, columns, strategy, order_by, keys) -> DataFrame:
    def chosen(name: str, numeric_only: bool) -> list[str]:
        return [c for c in columns if strategy[c] == name and (is_numeric(df, c) or not numeric_only)]

    new: dict[str, Column] = {}
    held: dict[str, Column] = {}
    means = chosen("mean", True)
    if means:
        held["__mean"] = scalars(df, **{c: F.avg(F.col(f"`{c}`")) for c in means})
        new |= {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.col("__mean")[c]) for c in means}
    medians = chosen("median", True)
    if medians:
        held["__median"] = table_quantiles(df, medians, [0.5])
        new |= {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.col("__median")[c][0]) for c in medians}
    for c in chosen("mode", False):
        new[c] = F.coalesce(F.col(f"`{c}`"), most_frequent(df, c))
    for c in chosen("zero", True):
        new[c] = F.coalesce(F.col(f"`{c}`"), F.lit(0).cast(df.schema[c].dataType))
    for c in chosen("unknown", False):
        new[c] = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("Unknown"))
    forward = chosen("forward_fill", False)
    if forward:
        if not order_by:
            raise ValueError("forward_fill needs order_by: a table has no row order of its own")
        df = forward_fill(df, forward, order_by, keys)
    return replace_columns(df, new, held) if new else df


# -- single columns -----------------------------------------------------------------------


def clean_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return replace_columns(df, {c: text.clean_text(F.col(f"`{c}`")) for c in present(df, columns)})


def parse_currency(df: DataFrame, columns: Sequence[str], thousands: str | None = None) -> DataFrame:
    """Numbers out of text columns; columns that are numbers already stay as they are."""
    texts = [c for c in present(df, columns) if not is_numeric(df, c)]
    return replace_columns(df, {c: numbers.parse_currency(F.col(f"`{c}`"), thousands) for c in texts})


def null_outliers(df: DataFrame, columns: Sequence[str], z: float = Thresholds.outlier_z) -> DataFrame:
    """Null where a value lies more than ``z`` sample deviations from the mean.

    The bound is multiplied out, so a constant column (deviation 0) loses nothing.
    """
    columns = [c for c in present(df, columns) if is_numeric(df, c)]
    if not columns:
        return df
    df = nan_as_null(df, columns)
    stats = F.col("__stats")
    held = scalars(
        df,
        **{c: F.struct(F.avg(F.col(f"`{c}`")).alias("mean"), F.stddev_samp(F.col(f"`{c}`")).alias("std")) for c in columns},
    )
    return replace_columns(
        df,
        {
            c: F.when(F.abs(F.col(f"`{c}`") - stats[c]["mean"]) > F.lit(z) * stats[c]["std"], None).otherwise(
                F.col(f"`{c}`")
            )
            for c in columns
        },
        {"__stats": held},
    )


def clean_numeric(
    df: DataFrame, columns: Sequence[str], thousands: str | None = None, z: float = Thresholds.outlier_z
) -> DataFrame:
    return null_outliers(parse_currency(df, columns, thousands), columns, z)


def standardize_dates(
    df: DataFrame, columns: Sequence[str], formats: Sequence[str] = dates.DATE_FORMATS
) -> DataFrame:
    texts = [c for c in present(df, columns) if isinstance(df.schema[c].dataType, T.StringType)]
    return replace_columns(df, {c: dates.parse_date(F.col(f"`{c}`"), formats) for c in texts})


def clean_categories(df: DataFrame, column: str, valid: Sequence[str] | None = None) -> DataFrame:
    """Title case; with a list, whatever is not on it (nulls too) becomes ``Other``."""
    if not present(df, [column]):
        return df
    titled = text.title_case(F.col(f"`{column}`").cast("string"))
    if valid:
        allowed = [text.title_case(F.lit(v)) for v in valid]
        titled = F.when(titled.isin(*allowed), titled).otherwise(F.lit("Other"))
    return replace_columns(df, {column: titled})


def clean_emails(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return replace_columns(df, {c: text.email_or_null(F.col(f"`{c}`")) for c in present(df, columns)})


# -- all of it ----------------------------------------------------------------------------


def clean_frame(
    df: DataFrame,
    config: Mapping | None = None,
    order_by: Sequence[Column] = (),
    keys: Sequence[str] = (),
    z: float = Thresholds.outlier_z,
    deduplicated: bool = False,
) -> DataFrame:
    """Deduplicate (unless the rows are ``deduplicated``), fill, then clean text, numbers, dates, categories and emails.

    The config maps ``missing_strategy``, ``text_columns``, ``numeric_columns``,
    ``date_columns``, ``categorical_columns`` (column to allowed values) and
    ``email_columns``. Filling comes before parsing, so a median has no effect on a money
    column that is still text; ``impute_after_parse`` turns the two round.

    Means, modes and deviations each read the deduplicated rows. Where there are any, these rows are
    written to the shared folder once, when this is called.
    """
    config = dict(config or {})
    strategy = config.get("missing_strategy", {})
    numeric = config.get("numeric_columns", [])
    thousands = config.get("thousands")

    if not deduplicated:
        df = drop_duplicates(nan_as_null(df))
        if strategy or present(df, numeric):
            df = written(df, "deduplicated")
    if config.get("impute_after_parse"):
        df = parse_currency(df, numeric, thousands)
    df = fill_missing(df, strategy, order_by, keys)
    df = clean_text(df, config.get("text_columns", []))
    df = clean_numeric(df, numeric, thousands, z)
    df = standardize_dates(df, config.get("date_columns", []), config.get("date_formats", dates.DATE_FORMATS))
    for column, valid in config.get("categorical_columns", {}).items():
        df = clean_categories(df, column, valid)
    return clean_emails(df, config.get("email_columns", []))
