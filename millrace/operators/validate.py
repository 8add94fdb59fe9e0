"""Validation: schema, data quality, business rules, completeness and the overall verdict.

Every check is an aggregate that yields one result row ``(part, check, column, status, value,
pct)``. All checks of a table go into one aggregate over it, whatever their number; only the
duplicate count needs a shuffle of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.config import Thresholds
from millrace.functions.numbers import percent
from millrace.operators.clean import distinct_counts

# Column names the consistency checks look for, and their limits.
NEVER_NEGATIVE = ("age", "salary", "experience", "price", "count")
MAY_BE_LARGE = ("id", "salary", "revenue", "investment")
LARGE_VALUE = 1e6
NOT_IN_FUTURE = ("birth_date", "hire_date")
OLDEST_DATE = datetime(1900, 1, 1)

# Report words for a status, and quality bands above a score.
STATUS_WORDS = {
    "passed": "APROBADO",
    "warning": "ADVERTENCIA",
    "failed": "FALLIDO",
    "error": "ERROR",
    "unknown": "DESCONOCIDO",
}
QUALITY_BANDS = ((90, "EXCELENTE"), (80, "BUENO"), (70, "REGULAR"))
LOWEST_QUALITY = "NECESITA_MEJORA"

# A failed rule outweighs one that could not be evaluated.
SEVERITY = {"skipped": 0, "passed": 0, "warning": 1, "error": 2, "failed": 3}

_DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)

# Type names with a width accept one type only.
_WIDTHS = {
    "int8": T.ByteType, "int16": T.ShortType, "int32": T.IntegerType, "int64": T.LongType,
    "float32": T.FloatType, "float64": T.DoubleType,
}


def _rows() -> Column:
    return F.count(F.lit(1))


def _result(part: str, check: str, column: str | None, status: Column, value=None, pct=None) -> Column:
    return F.struct(
        F.lit(part).alias("part"),
        F.lit(check).alias("check"),
        F.lit(column).cast("string").alias("column"),
        status.alias("status"),
        (F.lit(None) if value is None else value).cast("double").alias("value"),
        (F.lit(None) if pct is None else pct).cast("double").alias("pct"),
    )


def _flag(bad: Column, status: str) -> Column:
    return F.when(bad, F.lit(status)).otherwise(F.lit("passed"))


def run_checks(df: DataFrame, checks: Sequence[Column]) -> DataFrame:
    """All checks in one aggregate over the table, one result row each."""
    return df.agg(F.array(*checks).alias("r")).select(F.inline("r"))


# -- schema -------------------------------------------------------------------------------


def _same_type(actual: T.DataType, expected: str) -> bool:
    """Type families: the name ``int`` accepts all integers, ``float`` all floats, and so on;
    ``int64`` and other names with a width accept that type alone."""
    if expected in _WIDTHS:
        return isinstance(actual, _WIDTHS[expected])
    families = {
        "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
        "float": (T.FloatType, T.DoubleType, T.DecimalType),
        "string": (T.StringType,),
        "object": (T.StringType,),
        "datetime": _DATES,
        "bool": (T.BooleanType,),
    }
    for family, kinds in families.items():
        if expected.startswith(family):
            return isinstance(actual, kinds)
    return actual.simpleString() == T.DataType.fromDDL(expected).simpleString()


def _cast_target(expected: str) -> str:
    if expected in _WIDTHS:
        return _WIDTHS[expected]().simpleString()
    names = {"int": "bigint", "float": "double", "string": "string", "object": "string", "datetime": "timestamp", "bool": "boolean"}
    return next((kind for family, kind in names.items() if expected.startswith(family)), expected)


def schema_checks(df: DataFrame, expected: Mapping[str, str]) -> list[Column]:
    """Missing columns fail, extra columns and other types are warnings.

    For a column of another type the value counts the entries that cannot be cast.
    """
    checks = []
    for c, kind in expected.items():
        if c not in df.columns:
            checks.append(_result("schema", "missing_column", c, F.lit("failed")))
        elif not _same_type(df.schema[c].dataType, kind):
            col = F.col(f"`{c}`").cast("string")
            unfit = F.count_if(col.isNotNull() & col.try_cast(_cast_target(kind)).isNull())
            checks.append(_result("schema", "type", c, F.lit("warning"), unfit, percent(unfit, _rows())))
        else:
            checks.append(_result("schema", "type", c, F.lit("passed"), F.lit(0), F.lit(0)))
    for c in df.columns:
        if c not in expected:
            checks.append(_result("schema", "extra_column", c, F.lit("warning")))
    return checks


# -- quality ------------------------------------------------------------------------------


def min_rows_check(minimum: int = Thresholds.min_rows) -> Column:
    return _result("quality", "min_rows", None, _flag(_rows() < minimum, "failed"), _rows())


def missing_checks(df: DataFrame, max_pct: float = Thresholds.max_null_pct) -> list[Column]:
    checks = []
    for c in df.columns:
        nulls = _rows() - F.count(F.col(f"`{c}`"))
        over = F.coalesce(percent(nulls, _rows(), None) > max_pct, F.lit(False))
        checks.append(_result("quality", "missing", c, _flag(over, "warning"), nulls, percent(nulls, _rows())))
    return checks


def _numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _date_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _DATES)]


def negative_checks(df: DataFrame, names: Sequence[str] = NEVER_NEGATIVE) -> list[Column]:
    lows = {c: F.min(F.col(f"`{c}`")) for c in _numeric_columns(df) if c.lower() in names}
    return [
        _result("quality", "negative", c, _flag(F.coalesce(low < 0, F.lit(False)), "warning"), low)
        for c, low in lows.items()
    ]


def large_checks(
    df: DataFrame, exempt: Sequence[str] = MAY_BE_LARGE, limit: float = LARGE_VALUE
) -> list[Column]:
    highs = {c: F.max(F.col(f"`{c}`")) for c in _numeric_columns(df) if c.lower() not in exempt}
    return [
        _result("quality", "large", c, _flag(F.coalesce(high > limit, F.lit(False)), "warning"), high)
        for c, high in highs.items()
    ]


def future_checks(df: DataFrame, as_of: datetime, names: Sequence[str] = NOT_IN_FUTURE) -> list[Column]:
    dates = [c for c in _date_columns(df) if c.lower() in names]
    late = {c: F.coalesce(F.max(F.col(f"`{c}`")) > F.lit(as_of), F.lit(False)) for c in dates}
    counted = {c: F.count_if(F.col(f"`{c}`") > F.lit(as_of)) for c in dates}
    return [_result("quality", "future_date", c, _flag(late[c], "warning"), counted[c]) for c in dates]


def old_checks(df: DataFrame, oldest: datetime = OLDEST_DATE) -> list[Column]:
    dates = _date_columns(df)
    early = {c: F.coalesce(F.min(F.col(f"`{c}`")) < F.lit(oldest), F.lit(False)) for c in dates}
    counted = {c: F.count_if(F.col(f"`{c}`") < F.lit(oldest)) for c in dates}
    return [_result("quality", "old_date", c, _flag(early[c], "warning"), counted[c]) for c in dates]


def quality_checks(
    df: DataFrame, thresholds: Thresholds = Thresholds(), as_of: datetime | None = None
) -> list[Column]:
    return [
        min_rows_check(thresholds.min_rows),
        *missing_checks(df, thresholds.max_null_pct),
        *negative_checks(df),
        *large_checks(df),
        *future_checks(df, as_of or datetime.now()),
        *old_checks(df),
    ]


def check_duplicates(df: DataFrame, max_pct: float = Thresholds.max_duplicate_pct) -> DataFrame:
    """Rows beyond the first of their kind, told apart by 128-bit digests: no column is shuffled."""
    groups = distinct_counts(df)
    rows = F.coalesce(F.sum("__copies"), F.lit(0))
    extra = rows - F.count(F.lit(1))
    over = F.coalesce(percent(extra, rows, None) > max_pct, F.lit(False))
    return run_checks(
        groups, [_result("quality", "duplicates", None, _flag(over, "warning"), extra, percent(extra, rows))]
    )


# -- business rules -----------------------------------------------------------------------

# What breaks each relation.
_BROKEN = {
    ">": lambda a, b: a <= b,
    "<": lambda a, b: a >= b,
    ">=": lambda a, b: a < b,
    "<=": lambda a, b: a > b,
}


def _rule_columns(rule: Mapping) -> list[str]:
    return [rule["column1"], rule["column2"]] if rule["type"] == "relationship" else [rule["column"]]


def _column_kind(kind: T.DataType) -> str:
    """What a column can be compared with."""
    families = {"number": T.NumericType, "text": T.StringType, "date": _DATES, "bool": T.BooleanType}
    return next((name for name, kinds in families.items() if isinstance(kind, kinds)), "other")


def _value_kind(value) -> str:
    families = {"bool": bool, "number": (int, float, Decimal), "text": str, "date": (date, datetime)}
    return next((name for name, kinds in families.items() if isinstance(value, kinds)), "other")


def _is_date_text(value) -> bool:
    try:
        datetime.fromisoformat(value)
    except (TypeError, ValueError):
        return False
    return True


def _evaluable(df: DataFrame, rule: Mapping) -> bool:
    """Whether the types of a rule's sides can be compared, so that no row stops the report."""
    kinds = [_column_kind(df.schema[c].dataType) for c in _rule_columns(rule)]
    if rule["type"] == "relationship":
        return kinds[0] == kinds[1] != "other"
    if rule["type"] == "range":
        bounds = [b for b in (rule.get("min"), rule.get("max")) if b is not None]
        return all(_value_kind(b) == kinds[0] or (kinds[0] == "date" and _is_date_text(b)) for b in bounds)
    return True


def violation(df: DataFrame, rule: Mapping) -> Column:
    """True where a row breaks the rule. Nulls pass ranges and relations, but are no category.

    Valid values of another type than the column equal none of its values.
    """
    if rule["type"] == "range":
        c = F.col(f"`{rule['column']}`")
        bounds = []
        if rule.get("min") is not None:
            bounds.append(c < F.lit(rule["min"]))
        if rule.get("max") is not None:
            bounds.append(c > F.lit(rule["max"]))
        if not bounds:
            raise ValueError("a range rule needs min or max")
        broken = reduce(lambda a, b: a | b, bounds)
    elif rule["type"] == "categorical":
        kind = _column_kind(df.schema[rule["column"]].dataType)
        fitting = [v for v in rule.get("valid_values", []) if kind in (_value_kind(v), "date", "other")]
        broken = ~F.coalesce(F.col(f"`{rule['column']}`").isin(*fitting), F.lit(False)) if fitting else F.lit(True)
    elif rule["type"] == "relationship":
        operator = rule.get("operator", ">")
        if operator not in _BROKEN:
            raise ValueError(f"unknown operator {operator!r}")
        broken = _BROKEN[operator](F.col(f"`{rule['column1']}`"), F.col(f"`{rule['column2']}`"))
    else:
        raise ValueError(f"unknown rule type {rule['type']!r}")
    return F.coalesce(broken, F.lit(False))


def rule_checks(df: DataFrame, rules: Mapping[str, Mapping]) -> list[Column]:
    """Violations per rule. A rule on an absent column is ``skipped``; one that compares types which
    cannot be compared is an ``error`` and the others go on. Unknown rule types and operators raise."""
    checks = []
    for name, rule in rules.items():
        columns = _rule_columns(rule)
        label = " ".join(columns)
        if any(c not in df.columns for c in columns):
            checks.append(_result("rules", name, label, F.lit("skipped")))
            continue
        broken_row = violation(df, rule)
        if not _evaluable(df, rule):
            checks.append(_result("rules", name, label, F.lit("error")))
            continue
        broken = F.count_if(broken_row)
        checks.append(
            _result("rules", name, label, _flag(broken > 0, "failed"), broken, percent(broken, _rows()))
        )
    return checks


def invalid_values(df: DataFrame, rule: Mapping) -> DataFrame:
    """The distinct values that break a categorical rule, all of them, with their counts."""
    broken = df.where(violation(df, rule)).groupBy(F.col(f"`{rule['column']}`").alias("value"))
    return broken.agg(F.count(F.lit(1)).alias("rows"))


def invalid_value_rows(df: DataFrame, rules: Mapping[str, Mapping], most: int | None = None) -> DataFrame | None:
    """Report rows of all values that break categorical rules: ``part`` is ``invalid``, ``check`` the rule, ``column`` the
    value as text (null for missing ones) and ``value`` its rows. None without such a rule.

    All rules share one scan: a row gives an entry for each rule it breaks, and entries are counted in each task before the shuffle.
    ``most`` keeps the most frequent values of a rule only.
    """
    kept = {
        n: rule for n, rule in rules.items() if rule["type"] == "categorical" and rule["column"] in df.columns and _evaluable(df, rule)
    }
    if not kept:
        return None
    broken = [
        F.when(violation(df, rule), F.struct(F.lit(n).alias("check"), F.col(f"`{rule['column']}`").cast("string").alias("text")))
        for n, rule in kept.items()
    ]
    counted = df.select(F.inline(F.array_compact(F.array(*broken)))).groupBy("check", "text").agg(F.count(F.lit(1)).alias("n"))
    if most is not None:
        window = Window.partitionBy("check").orderBy(F.desc("n"), F.asc("text"))
        counted = counted.withColumn("__row", F.row_number().over(window)).where(F.col("__row") <= most)
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counted.select(
        F.lit("invalid").alias("part"), "check", F.col("text").alias("column"), F.lit("failed").alias("status"),
        F.col("n").cast("double").alias("value"), percent(F.col("n"), total).cast("double").alias("pct"),
    )


# -- completeness -------------------------------------------------------------------------


def completeness_checks(
    df: DataFrame, required: Sequence[str] | None = None, minimum: float = Thresholds.min_completeness_pct
) -> list[Column]:
    """Filled share per required column and, as ``score``, their mean; absent columns count 0."""
    required = list(df.columns if required is None else required)
    checks, shares = [], []
    for c in required:
        if c not in df.columns:
            checks.append(_result("completeness", "completeness", c, F.lit("failed"), F.lit(0), F.lit(0)))
            continue
        filled = F.count(F.col(f"`{c}`"))
        share = F.coalesce(percent(filled, _rows(), None), F.lit(0.0))
        checks.append(
            _result("completeness", "completeness", c, _flag(share < minimum, "warning"), filled, percent(filled, _rows()))
        )
        shares.append(share)
    if required:
        score = reduce(lambda a, b: a + b, shares, F.lit(0.0)) / F.lit(float(len(required)))
        checks.append(
            _result("completeness", "score", None, F.lit("passed"), F.rint(score * 100.0) / 100.0)
        )
    return checks


# -- report -------------------------------------------------------------------------------


def worst(status: Column) -> Column:
    """Most severe status of a group, as an aggregate: failed, error, warning, passed."""
    rank = F.coalesce(*[F.when(status == s, F.lit(v)) for s, v in SEVERITY.items()])
    top = F.max(rank)
    names = {v: s for s, v in SEVERITY.items() if s != "skipped"}
    return F.coalesce(*[F.when(top == v, F.lit(s)) for v, s in sorted(names.items())], F.lit("passed"))


def _decides(result) -> Column:
    """Whether a result counts for the verdict: rules, completeness and missing columns do.
    Quality findings, extra columns, other types and rules that could not be evaluated are
    reported but decide nothing."""
    part, status = result["part"], result["status"]
    decides = part.isin("rules", "completeness") | ((part == "schema") & (status == "failed"))
    return decides & (status != "error")


def _verdict(results: Column) -> Column:
    """Overall result row of an array of result rows."""

    def any_is(status: str) -> Column:
        return F.exists(results, lambda x: _decides(x) & (x["status"] == status))

    status = F.lit("passed")
    for name in ("warning", "failed"):
        status = F.when(any_is(name), F.lit(name)).otherwise(status)
    return _result("overall", "status", None, status)


def overall_status(results: DataFrame) -> DataFrame:
    """One row per dataset (if there is such a column) with the overall verdict."""
    keys = [c for c in ("dataset",) if c in results.columns]
    decides = _decides({"part": F.col("part"), "status": F.col("status")})
    decisive = F.when(decides, F.col("status")).otherwise(F.lit("passed"))
    return results.groupBy(*keys).agg(worst(decisive).alias("status"))


def rules_status(results: DataFrame) -> DataFrame:
    keys = [c for c in ("dataset",) if c in results.columns]
    return results.where("part = 'rules'").groupBy(*keys).agg(worst(F.col("status")).alias("status"))


def validation_report(
    df: DataFrame,
    config: Mapping | None = None,
    dataset: str = "data",
    thresholds: Thresholds = Thresholds(),
    as_of: datetime | None = None,
) -> DataFrame:
    """Every check of a dataset as long rows, the overall verdict last (part ``overall``).

    The config maps ``schema``, ``business_rules``, ``required_columns`` and ``max_invalid_values`` (all by default). Values that
    break categorical rules follow as rows of part ``invalid``.
    """
    config = dict(config or {})
    checks = quality_checks(df, thresholds, as_of)
    if config.get("schema"):
        checks += schema_checks(df, config["schema"])
    if config.get("business_rules"):
        checks += rule_checks(df, config["business_rules"])
    checks += completeness_checks(df, config.get("required_columns"), thresholds.min_completeness_pct)
    # One aggregate holds all results in one row; the verdict is read off that row.
    held = df.agg(F.array(*checks).alias("r")).withColumn("r", F.concat("r", F.array(_verdict(F.col("r")))))
    results = held.select(F.inline("r"))
    rows = results.unionByName(check_duplicates(df, thresholds.max_duplicate_pct))
    invalid = invalid_value_rows(df, config.get("business_rules") or {}, config.get("max_invalid_values"))
    if invalid is not None:
        rows = rows.unionByName(invalid)
    return rows.select(F.lit(dataset).alias("dataset"), "*")


def translate_status(report: DataFrame) -> DataFrame:
    """Add the report word of each status."""
    words = F.coalesce(*[F.when(F.col("status") == s, F.lit(w)) for s, w in STATUS_WORDS.items()], F.upper("status"))
    return report.withColumn("estado", words)


def completeness_score(report: DataFrame) -> DataFrame:
    return report.where("part = 'completeness' AND check = 'score'").select("dataset", F.col("value").alias("score"))


def quality_band(score: Column) -> Column:
    chain = F
    for limit, name in QUALITY_BANDS:
        chain = chain.when(score > limit, F.lit(name))
    return chain.otherwise(F.lit(LOWEST_QUALITY))


def quality_score(reports: DataFrame) -> DataFrame:
    """Mean completeness score of the datasets and its band."""
    mean = completeness_score(reports).agg(F.avg("score").alias("score"))
    return mean.select((F.rint(F.col("score") * 100.0) / 100.0).alias("score"), quality_band(F.col("score")).alias("band"))
