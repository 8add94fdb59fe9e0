"""Transformation: names, derived columns, encodings, scaling, bins, joins, pivots, text."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import bands as B
from millrace.functions import text
from millrace.operators.clean import is_numeric, present
from millrace.operators.lookup import fits_broadcast, join_lookup, scalars
from millrace.operators.quantiles import quantile_table, table_quantiles
from millrace.operators.slices import rank_within
from millrace.session import settle

#: Values that a column may spread over columns if they are not given; every caller can pass another limit.
MAX_CATEGORIES = 1_000
#: Pairs of rows that a block of a hot key's join makes, about, and tasks over which the blocks of all hot keys are dealt, at most.
PAIRS_PER_BLOCK, MAX_BLOCK_TASKS = 4_000_000, 2_000

# -- names and derived columns ------------------------------------------------------------


def normalized_name(name: str) -> str:
    kept = re.sub(r"[^\w\s]", "", name.lower())
    return re.sub(r"\s+", "_", kept).strip("_")


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower case, words joined by underscores, accents kept."""
    names = [normalized_name(c) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"column names collide once normalized: {sorted(names)}")
    return df.toDF(*names)


def add_band(df: DataFrame, column: str, bands: B.Bands, out: str, include_lowest: bool = False) -> DataFrame:
    return df.withColumn(out, B.band(F.col(column), bands, include_lowest))


def date_parts(df: DataFrame) -> DataFrame:
    """Year, month and quarter of every date and timestamp column."""
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    parts = []
    for field in df.schema.fields:
        if isinstance(field.dataType, kinds):
            for part, function in (("year", F.year), ("month", F.month), ("quarter", F.quarter)):
                parts.append(function(F.col(f"`{field.name}`")).alias(f"{field.name}_{part}"))
    return df.select("*", *parts)


def derive_columns(df: DataFrame, age: str = "age", salary: str = "salary") -> DataFrame:
    if age in df.columns:
        df = add_band(df, age, B.AGE_GROUP, f"{age}_group")
    if salary in df.columns:
        df = add_band(df, salary, B.SALARY_RANGE, f"{salary}_range")
    return date_parts(df)


# -- encodings ----------------------------------------------------------------------------


def categories(df: DataFrame, column: str, limit: int = MAX_CATEGORIES) -> list:
    """Sorted values of a column that becomes columns itself; too many raise."""
    found = df.where(F.col(f"`{column}`").isNotNull()).select(f"`{column}`").distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} values to spread over columns")
    return sorted(r[0] for r in found)


def one_hot(df: DataFrame, column: str, values: Sequence | None = None, limit: int = MAX_CATEGORIES) -> DataFrame:
    """Indicator per value but the first; a null row has none set. Given values save a job and have no limit."""
    values = sorted(values) if values is not None else categories(df, column, limit)
    return df.select(
        "*",
        *[F.coalesce(F.col(f"`{column}`") == F.lit(v), F.lit(False)).alias(f"{column}_{v}") for v in values[1:]],
    )


def label_encode(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Rank of the value among the sorted values, from 0; null is -1."""
    return label_encode_all(df, {column: out or f"{column}_encoded"})


def label_encode_all(df: DataFrame, outs: Mapping[str, str]) -> DataFrame:
    """Label codes of several columns; columns of one type share the pass for their values."""
    kinds: dict[T.DataType, list[str]] = {}
    for c in outs:
        kinds.setdefault(df.schema[c].dataType, []).append(c)
    coded = df
    for columns in kinds.values():
        entries = F.array(*[F.struct(F.lit(c).alias("__of"), F.col(f"`{c}`").alias("__value")) for c in columns])
        values = settle(df.select(F.inline(entries)).where(F.col("__value").isNotNull()).distinct())
        small = fits_broadcast(values)
        codes = rank_within(values, [F.col("__value")], "__code", ["__of"], small=small)
        if not small and len(columns) > 1:
            codes = settle(codes)
        for c in columns:
            one = codes.where(F.col("__of") == c).select(F.col("__value").alias(c), F.col("__code").alias(f"__code_{c}"))
            coded = join_lookup(coded, one, [c], broadcast=small)
    return coded.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[F.coalesce(F.col(f"`__code_{c}`") - 1, F.lit(-1)).cast("int").alias(out) for c, out in outs.items()],
    )


def target_encode(df: DataFrame, column: str, target: str) -> DataFrame:
    """Mean of the target per value; null values stay null."""
    means = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.avg(target).alias(f"{column}_target_encoded"))
    return join_lookup(df, settle(means), [column])


def encode(df: DataFrame, config: Mapping[str, str]) -> DataFrame:
    """``{column: method}``; the entry ``target_column`` names the target of ``target``."""
    target = config.get("target_column")
    for column, method in config.items():
        if column == "target_column" or not present(df, [column]):
            continue
        if method == "one_hot":
            df = one_hot(df, column)
        elif method == "label":
            df = label_encode(df, column)
        elif method == "target":
            if target not in df.columns:
                raise ValueError("target encoding needs an existing target_column")
            df = target_encode(df, column, target)
        else:
            raise ValueError(f"unknown encoding {method!r}")
    return df


# -- aggregation --------------------------------------------------------------------------

# Functions that Spark aggregates directly; median joins in from the exact quantiles.
AGGREGATES = {
    "mean": F.avg,
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
    "var": F.var_samp,
    "nunique": F.count_distinct,
    "size": lambda c: F.count(F.lit(1)),
}
PICKS = {"first": F.min_by, "last": F.max_by}


def aggregate(
    df: DataFrame,
    group_by: Sequence[str],
    aggregations: Mapping[str, str | Sequence[str]],
    order_by: Sequence[Column] = (),
) -> DataFrame:
    """Group and aggregate by name; rows with a null key are left out.

    Any list among the values names all results ``column_function``; plain values keep the
    column name. ``first`` and ``last`` are the first and last non-null value in ``order_by``.
    """
    missing = [c for c in [*group_by, *aggregations] if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    listed = any(not isinstance(f, str) for f in aggregations.values())
    keys = list(group_by)
    df = df.dropna(subset=keys)
    results, picks, medians = [], [], {}
    for column, functions in aggregations.items():
        for name in [functions] if isinstance(functions, str) else functions:
            out = f"{column}_{name}" if listed else column
            if name == "median":
                medians[out] = column
                continue
            if name in PICKS:
                if not order_by:
                    raise ValueError(f"{name} needs order_by")
                place = order_by[0] if len(order_by) == 1 else F.struct(*order_by)
                value = PICKS[name](F.col(column), F.when(F.col(column).isNotNull(), place))
                picks.append((out, value))
                continue
            if name in AGGREGATES:
                value = AGGREGATES[name](F.col(column))
            else:
                raise ValueError(f"unknown aggregate {name!r}")
            results.append((out, value))
    # A pick by several order columns sorts its rows, so it does not share the hash aggregate.
    if len(order_by) == 1:
        results, picks = results + picks, []
    parts = [df.groupBy(*keys).agg(*[v.alias(o) for o, v in p]) for p in (results, picks) if p]
    if medians:
        table = quantile_table(df, sorted(set(medians.values())), [0.5], keys)
        found = [F.max(F.when(F.col("column") == c, F.col("q")[0])).alias(o) for o, c in medians.items()]
        parts.append(table.groupBy(*keys).agg(*found))
    grouped = parts[0] if results or picks else df.select(*keys).distinct()
    for part in parts[1 if results or picks else 0 :]:
        grouped = join_lookup(grouped, part, keys, broadcast=False)
    return grouped


# -- scaling and bins ---------------------------------------------------------------------


def scale(df: DataFrame, columns: Sequence[str], method: str = "min_max") -> DataFrame:
    """Add ``column_normalized``; a spread of zero gives null."""
    columns = [c for c in present(df, columns) if is_numeric(df, c)]
    if not columns:
        return df
    stats = F.col("__s")
    if method == "min_max":
        held = scalars(df, **{c: F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")) for c in columns})
        parts = {c: (stats[c]["lo"], stats[c]["hi"] - stats[c]["lo"]) for c in columns}
    elif method == "z_score":
        held = scalars(df, **{c: F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")) for c in columns})
        parts = {c: (stats[c]["mean"], stats[c]["std"]) for c in columns}
    elif method == "robust":
        held = table_quantiles(df, columns, [0.25, 0.5, 0.75])
        parts = {c: (stats[c][1], stats[c][2] - stats[c][0]) for c in columns}
    else:
        raise ValueError(f"unknown scaling {method!r}")
    return df.withColumn("__s", held).select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[
            F.try_divide((F.col(c) - center).cast("double"), spread.cast("double")).alias(f"{c}_normalized")
            for c, (center, spread) in parts.items()
        ],
    )


def bin_edges(df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str] | None = None) -> DataFrame:
    """Right-closed bins between given edges, the lowest edge included."""
    labels = labels or B.interval_labels(edges, include_lowest=True)
    return add_band(df, column, B.Bands(tuple(edges), tuple(labels)), f"{column}_binned", include_lowest=True)


def _labelled(index: Column, labels: Sequence[str] | None) -> Column:
    if not labels:
        return index
    return F.coalesce(*[F.when(index == i, F.lit(label)) for i, label in enumerate(labels)])


def bin_equal_width(df: DataFrame, column: str, bins: int, labels: Sequence[str] | None = None) -> DataFrame:
    """``bins`` right-closed bins of equal width; labels, or bin numbers from 0.

    A constant column falls into the middle bin.
    """
    if labels and len(labels) != bins:
        raise ValueError("as many labels as bins are needed")
    held = scalars(df, lo=F.min(column).cast("double"), hi=F.max(column).cast("double"))
    x, low = F.col(column).cast("double"), F.col("__s")["lo"]
    width = (F.col("__s")["hi"] - low) / F.lit(float(bins))
    place = F.ceil(F.try_divide(x - low, width)) - 1
    index = F.when(x.isNotNull(), F.when(width == 0, F.lit((bins - 1) // 2)).otherwise(
        F.least(F.lit(bins - 1), F.greatest(F.lit(0), place))).cast("int"))
    return df.withColumn("__s", held).withColumn(f"{column}_binned", _labelled(index, labels)).drop("__s")


def bin_quantile(df: DataFrame, column: str, bins: int, labels: Sequence[str] | None = None) -> DataFrame:
    """Bins between the k/bins quantiles, right-closed, lowest included; labels or numbers.

    Equal edges count once. Labels must then be as many as the bins that are left: the check
    runs with the query and raises there.
    """
    edges = table_quantiles(df, [column], [k / bins for k in range(bins + 1)])[column]
    edged = df.withColumn("__edges", F.array_distinct(edges))
    x = F.col(column).cast("double")
    lowest = F.when(x == F.element_at("__edges", 1), F.lit(1)).otherwise(F.lit(0))
    passed = sum(
        (F.when(F.try_element_at("__edges", F.lit(k + 1)) < x, 1).otherwise(0) for k in range(bins + 1)), lowest
    )
    index = F.when(x.isNotNull(), (passed - 1).cast("int"))
    if labels:
        fitting = F.size("__edges") - 1 == len(labels)
        index = F.when(fitting, _labelled(index, labels)).otherwise(
            F.raise_error(F.lit("labels and quantile bins differ in number")).cast("string")
        )
    return edged.withColumn(f"{column}_binned", index).drop("__edges")


def bin_columns(df: DataFrame, config: Mapping[str, Mapping]) -> DataFrame:
    """``{column: {bins, labels, method}}`` with method ``cut`` or ``qcut``."""
    for column, spec in config.items():
        if not present(df, [column]):
            continue
        bins, labels, method = spec["bins"], spec.get("labels"), spec.get("method", "cut")
        if method == "cut" and isinstance(bins, int):
            df = bin_equal_width(df, column, bins, labels)
        elif method == "cut":
            df = bin_edges(df, column, bins, labels)
        elif method == "qcut":
            df = bin_quantile(df, column, bins, labels)
        else:
            raise ValueError(f"unknown binning {method!r}")
    return df


# -- joins --------------------------------------------------------------------------------


def merge(
    left: DataFrame,
    right: DataFrame,
    left_on: str | Sequence[str] | None = None,
    right_on: str | Sequence[str] | None = None,
    how: str = "inner",
    suffixes: tuple[str, str] = ("_x", "_y"),
    null_keys: bool = True,
) -> DataFrame:
    """Equi-join where null keys match null keys.

    Equally named keys become one column; other columns both sides have get the suffixes.
    An outer join runs as a left join plus the unmatched right rows: AQE splits a hot key in
    those two, not in a full outer join. Keys of more than ``PAIRS_PER_BLOCK`` pairs of rows are joined in blocks
    (``_merge_hot``), as a join by key alone makes all of a key's pairs in one task. Without keys the columns that both sides have are the
    keys. Null keys of both sides multiply; ``null_keys=False`` lets them match nothing. A cross join
    gives every pair, so one side should be a small table of the caller's.
    """
    if how == "cross":
        return _merge_cross(left, right, suffixes)
    if how not in ("inner", "left", "right", "outer"):
        raise ValueError(f"unknown join {how!r}")
    lkeys = [left_on] if isinstance(left_on, str) else list(left_on or [])
    rkeys = [right_on] if isinstance(right_on, str) else list(right_on or lkeys)
    if not lkeys and not rkeys:
        lkeys = rkeys = [c for c in left.columns if c in right.columns]
    if not lkeys or len(lkeys) != len(rkeys):
        raise ValueError("left_on and right_on must name as many columns")
    shared_keys = {lk for lk, rk in zip(lkeys, rkeys, strict=True) if lk == rk}
    overlap = (set(left.columns) & set(right.columns)) - shared_keys
    lhs = left.toDF(*[f"__l_{c}" for c in left.columns])
    rhs = right.toDF(*[f"__r_{c}" for c in right.columns])
    same = Column.eqNullSafe if null_keys else Column.__eq__
    match = reduce(
        lambda a, b: a & b,
        [same(F.col(f"`__l_{lk}`"), F.col(f"`__r_{rk}`")) for lk, rk in zip(lkeys, rkeys, strict=True)],
    )

    def output(joined: DataFrame) -> DataFrame:
        def side(prefix: str, c: str) -> Column:
            name = f"__{prefix}_{c}"
            if name in joined.columns:
                return F.col(f"`{name}`")
            return F.lit(None).cast((left if prefix == "l" else right).schema[c].dataType)

        columns = []
        for c in left.columns:
            value = F.coalesce(side("l", c), side("r", c)) if c in shared_keys else side("l", c)
            columns.append(value.alias(c + suffixes[0] if c in overlap else c))
        for c in right.columns:
            if c not in shared_keys:
                columns.append(side("r", c).alias(c + suffixes[1] if c in overlap else c))
        return joined.select(*columns)

    hot = _hot_keys(lhs, rhs, [f"__l_{k}" for k in lkeys], [f"__r_{k}" for k in rkeys], match)
    most = hot.agg(F.max("__a"), F.max("__b"), F.sum(F.col("__a") * F.col("__b"))).first()
    if most[2]:
        # each side has rows of a hot key, so these need nothing but pairs, however the rest is joined
        pairs = output(_merge_hot(lhs, rhs, hot, match, *most))
        known = F.broadcast(hot)
        lhs = lhs.join(known.select(*[f"`{c}`" for c in hot.columns if c.startswith("__r_")]), match, "left_anti")
        rhs = rhs.join(known.select(*[f"`{c}`" for c in hot.columns if c.startswith("__l_")]), match, "left_anti")
    if how == "outer":
        unmatched = rhs.join(lhs.select(*[f"`__l_{k}`" for k in lkeys]), match, "left_anti")
        joined = output(lhs.join(rhs, match, "left")).unionByName(output(unmatched))
    else:
        joined = output(lhs.join(rhs, match, how))
    return joined.unionByName(pairs) if most[2] else joined


def _hot_keys(lhs: DataFrame, rhs: DataFrame, lkeys: Sequence[str], rkeys: Sequence[str], match: Column) -> DataFrame:
    """Keys of more than ``PAIRS_PER_BLOCK`` pairs: the keys of both sides, a number ``__hot``, and into how many parts the
    rows of the left (``__a``) and right side (``__b``) are dealt, so that a part of each makes about as many pairs as that.

    One side has at least the root of that many rows for each, so there are few and they fit a broadcast.
    """
    left = lhs.groupBy(*[f"`{k}`" for k in lkeys]).agg(F.count(F.lit(1)).cast("double").alias("__nl"))
    right = rhs.groupBy(*[f"`{k}`" for k in rkeys]).agg(F.count(F.lit(1)).cast("double").alias("__nr"))
    nl, nr, side = F.col("__nl"), F.col("__nr"), PAIRS_PER_BLOCK**0.5

    def parts(own: Column, other: Column) -> Column:
        return F.ceil(own / F.when(other < side, PAIRS_PER_BLOCK / other).otherwise(side))

    hot = left.join(right, match).where(nl * nr > PAIRS_PER_BLOCK)
    hot = hot.withColumns({"__a": parts(nl, nr), "__b": parts(nr, nl), "__hot": F.monotonically_increasing_id()})
    return settle(hot.drop("__nl", "__nr"))


def _merge_hot(lhs: DataFrame, rhs: DataFrame, hot: DataFrame, match: Column, most_a: int, most_b: int, blocks: int) -> DataFrame:
    """All pairs of rows of hot keys: every part of the left side meets every part of the right one in a block of its own."""
    spark = hot.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def dealt(rows: DataFrame, other: str, most: int, own: str, met: str) -> DataFrame:
        known = hot.drop(*[c for c in hot.columns if c.startswith("__l_" if other == "__r_" else "__r_")])
        held = rows.join(F.broadcast(known), match).drop(*[c for c in hot.columns if c.startswith(other)])
        # dealt round by Spark, also rows that are equal
        held = held.repartition(max(least, most)).withColumn(f"__of{own}", F.pmod(F.spark_partition_id().cast("long"), F.col(own)))
        held = held.withColumn(f"__of{met}", F.explode(F.sequence(F.lit(0).cast("long"), F.col(met) - 1)))
        return held.drop("__a", "__b").repartition(min(blocks, MAX_BLOCK_TASKS), "__hot", "__of__a", "__of__b")

    left = dealt(lhs, "__r_", most_a, "__a", "__b")
    right = dealt(rhs, "__l_", most_b, "__b", "__a")
    return left.join(right.hint("shuffle_hash"), ["__hot", "__of__a", "__of__b"]).drop("__hot", "__of__a", "__of__b")


def _merge_cross(left: DataFrame, right: DataFrame, suffixes: tuple[str, str]) -> DataFrame:
    overlap = set(left.columns) & set(right.columns)
    lhs = left.toDF(*[c + suffixes[0] if c in overlap else c for c in left.columns])
    rhs = right.toDF(*[c + suffixes[1] if c in overlap else c for c in right.columns])
    return lhs.crossJoin(rhs)


# -- text features and pivots -------------------------------------------------------------


def text_features(
    df: DataFrame, column: str, keywords: Sequence[str] = text.TECH_KEYWORDS
) -> DataFrame:
    """Length, word count and a flag per keyword; length and count of a null are null."""
    if not present(df, [column]):
        return df
    c = F.col(f"`{column}`").cast("string")
    new = {f"{column}_length": F.length(c), f"{column}_word_count": text.word_count(c)}
    new |= {f"has_{k.replace(' ', '_')}": text.has_keyword(c, k) for k in keywords}
    return df.withColumns(new)


def pivot(
    df: DataFrame,
    index: str | Sequence[str],
    columns: str,
    values: str | Sequence[str],
    aggfunc: str | Sequence[str] = "mean",
    column_values: Sequence | None = None,
    order_by: str | None = None,
    limit: int = MAX_CATEGORIES,
) -> DataFrame:
    """Index by column table of aggregates; empty cells are 0.

    Given ``column_values`` save the job that finds them and have no limit. Several ``values`` give columns
    named ``values_column``, several functions ``function_values_column``. ``first`` and ``last`` go by the column
    ``order_by``. ``median`` is exact: cells are groups of ``quantile_table``, which holds no cell's values in one task.
    """
    functions = [aggfunc] if isinstance(aggfunc, str) else list(aggfunc)

    def aggregate_of(name: str, c: Column) -> Column:
        if name in PICKS:
            if order_by is None:
                raise ValueError(f"{name} needs order_by: a table has no row order of its own")
            return PICKS[name](c, F.when(c.isNotNull(), F.col(f"`{order_by}`")))
        if name not in AGGREGATES:
            raise ValueError(f"unknown aggregate {name!r}")
        return AGGREGATES[name](c)

    keys = [index] if isinstance(index, str) else list(index)
    listed = not isinstance(values, str)
    measures = list(values) if listed else [values]
    cells = [(f, m) for f in functions for m in measures]
    df = df.dropna(subset=[f"`{c}`" for c in [*keys, columns]])
    if not set(functions) & {"sum", "count", "size"}:
        df = df.dropna(how="all", subset=[f"`{m}`" for m in measures])
    if column_values is None:
        column_values = categories(df, columns, limit)
    plain = [(i, f, m) for i, (f, m) in enumerate(cells) if f != "median"]
    # two more beside them: with one aggregate alone the pivoted columns would be named otherwise
    aggregates = [aggregate_of(f, F.col(f"`{m}`")).alias(f"__{i}") for i, f, m in plain]
    beside = [F.max(F.lit(1)).alias(n) for n in ("__v", "__w")]
    wide = df.groupBy(*[f"`{k}`" for k in keys]).pivot(columns, list(column_values)).agg(*aggregates, *beside)
    if "median" in functions:
        wide = _with_medians(wide, df, keys, columns, measures, column_values, [i for i, (f, _) in enumerate(cells) if f == "median"])
    out = []
    for i, (f, m) in enumerate(cells):
        for v in column_values:
            name = f"{m}_{v}" if listed or len(functions) > 1 else f"{v}"
            out.append(F.coalesce(F.col(f"`{v}___{i}`"), F.lit(0)).alias(f"{f}_{name}" if len(functions) > 1 else name))
    return wide.select(*[f"`{k}`" for k in keys], *out)


def _with_medians(wide: DataFrame, df: DataFrame, keys: list, columns: str, measures: list, column_values: Sequence, places: list[int]) -> DataFrame:
    """Adds the medians ``value___i`` of each cell of a pivoted table."""
    shown = df.where(F.col(f"`{columns}`").isin(*column_values))
    # names of their own: the long table has a column called column
    named = shown.select(
        *[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)], F.col(f"`{columns}`").alias("__of"),
        *[F.col(f"`{m}`").cast("double").alias(f"__m{i}") for i, m in enumerate(measures)],
    )
    own = [f"__k{i}" for i in range(len(keys))]
    cells = quantile_table(named, [f"__m{i}" for i in range(len(measures))], [0.5], [*own, "__of"])
    middle = [F.max(F.when(F.col("column") == f"__m{i}", F.col("q")[0])).alias(f"__{place}") for i, place in enumerate(places)]
    medians = cells.groupBy(*own).pivot("__of", list(column_values)).agg(*middle, F.max(F.lit(1)).alias("__v"))
    medians = medians.select(*own, *[f"`{v}___{i}`" for v in column_values for i in places])
    match = reduce(lambda a, b: a & b, [F.col(f"`{k}`") == F.col(f"__k{i}") for i, k in enumerate(keys)])
    return wide.join(medians, match, "left").drop(*own)


# -- all of it ----------------------------------------------------------------------------


def transform_frame(df: DataFrame, config: Mapping | None = None) -> DataFrame:
    """Names, derived columns, encodings, scaling, bins, text features, each if configured."""
    config = dict(config or {})
    if config.get("normalize_columns", True):
        df = normalize_names(df)
    if config.get("create_derived", True):
        df = derive_columns(df, config.get("age_column", "age"), config.get("salary_column", "salary"))
    if config.get("encoding"):
        df = encode(df, config["encoding"])
    if config.get("normalization"):
        spec = config["normalization"]
        df = scale(df, spec.get("columns", []), spec.get("method", "min_max"))
    if config.get("binning"):
        df = bin_columns(df, config["binning"])
    for column in config.get("text_features", []):
        df = text_features(df, column)
    return df
