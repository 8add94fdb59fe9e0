"""Validation queries. Result rows are ``part, check, column, status, value, pct``."""

from __future__ import annotations

from datetime import datetime


from millrace.operators import clean, validate
from millrace.queries.base import query, r, rounded

AS_OF = datetime(2000, 1, 1)


def row(part, check, column, status, value="NULL", pct="NULL", source=""):
    """One result row in SQL; ``status`` is an expression."""
    name = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    v = value if value == "NULL" else r(value)
    p = pct if pct == "NULL" else r(pct, 2)
    return f"""SELECT '{part}' AS part, '{check}' AS "check", {name} AS "column", {status} AS status,
 CAST({v} AS DOUBLE) AS value, CAST({p} AS DOUBLE) AS pct{' FROM ' + source if source else ''}"""


def flag(bad, status):
    return f"CASE WHEN {bad} THEN '{status}' ELSE 'passed' END"


def share(x):
    return f"({x}) * 100.0 / count(*)"


# A table whose types differ from the expected ones: numbers as text, some of them no numbers.
TEXTUAL = """SELECT l_orderkey, CASE WHEN l_orderkey % 50 = 0 THEN 'n.d.' ELSE CAST(l_linenumber AS STRING) END AS linenumber,
 l_quantity, l_shipdate, l_comment_code FROM (SELECT *, l_returnflag AS l_comment_code FROM {lineitem})"""
EXPECTED = {"l_orderkey": "int64", "linenumber": "int64", "l_quantity": "float64", "l_shipdate": "datetime64[ns]", "l_extra": "string"}


@query(
    "schema_check",
    " UNION ALL ".join(
        [
            row("schema", "type", "l_orderkey", "'passed'", "0", "0"),
            row("schema", "type", "l_quantity", "'passed'", "0", "0"),
            row("schema", "type", "l_shipdate", "'passed'", "0", "0"),
            row("schema", "missing_column", "l_extra", "'failed'"),
            row("schema", "extra_column", "l_comment_code", "'warning'"),
            row(
                "schema", "type", "linenumber", "'warning'", "count(*) FILTER (l_orderkey % 50 = 0)",
                share("count(*) FILTER (l_orderkey % 50 = 0)"), "lineitem",
            ),
        ]
    ),
)
def _(t):
    df = t.sql(TEXTUAL)
    return rounded(validate.run_checks(df, validate.schema_checks(df, EXPECTED)))


@query("check_min_rows", row("quality", "min_rows", None, flag("count(*) < 100", "failed"), "count(*)", source="region")
       + " UNION ALL " + row("quality", "min_rows", None, flag("count(*) < 100", "failed"), "count(*)", source="lineitem"))
def _(t):
    checks = [validate.min_rows_check()]
    return validate.run_checks(t.region, checks).unionByName(validate.run_checks(t.lineitem, checks))


PROFILED = """SELECT quantity, price, flag, CASE WHEN l_orderkey % 3 = 0 THEN l_orderkey END AS mostly_null FROM {gappy}"""


@query(
    "check_missing",
    " UNION ALL ".join(
        row("quality", "missing", c, flag(f"{share(f'count(*) - count({c})')} > 50", "warning"),
            f"count(*) - count({c})", share(f"count(*) - count({c})"), f"({PROFILED})")
        for c in ("quantity", "price", "flag", "mostly_null")
    ),
)
def _(t):
    df = t.sql(PROFILED)
    return rounded(validate.run_checks(df, validate.missing_checks(df)))


@query(
    "check_duplicates",
    row("quality", "duplicates", None, flag("(sum(c) - count(*)) * 100.0 / sum(c) > 5", "warning"), "sum(c) - count(*)",
        "(sum(c) - count(*)) * 100.0 / sum(c)", "(SELECT count(*) AS c FROM {copied} GROUP BY ALL)")
    .replace("SELECT count(*) AS c FROM {copied} GROUP BY ALL",
             "SELECT count(*) AS c FROM {copied} GROUP BY o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"),
)
def _(t):
    return rounded(validate.check_duplicates(t.copied))


ACCOUNTS = """SELECT c_acctbal AS salary, c_acctbal * 2000 AS amount, CAST(c_custkey % 80 AS INT) AS age,
 c_custkey AS id FROM {customer}"""


@query(
    "check_negative",
    " UNION ALL ".join(
        row("quality", "negative", c, flag(f"min({c}) < 0", "warning"), f"min({c})", source=f"({ACCOUNTS})")
        for c in ("salary", "age")
    ),
)
def _(t):
    df = t.sql(ACCOUNTS)
    return rounded(validate.run_checks(df, validate.negative_checks(df)))


@query(
    "check_large",
    " UNION ALL ".join(
        row("quality", "large", c, flag(f"max({c}) > 1000000", "warning"), f"max({c})", source=f"({ACCOUNTS})")
        for c in ("amount", "age")
    ),
)
def _(t):
    df = t.sql(ACCOUNTS)
    return rounded(validate.run_checks(df, validate.large_checks(df)))


STAFF = """SELECT o_orderdate AS hire_date, o_orderdate AS seen_date,
 CASE WHEN o_orderkey % 400 = 0 THEN CAST('1850-06-01' AS TIMESTAMP) ELSE CAST(o_orderdate AS TIMESTAMP) END AS birth_date FROM {orders}"""


@query(
    "check_future",
    " UNION ALL ".join(
        row("quality", "future_date", c, flag(f"max({c}) > TIMESTAMP '2000-01-01'", "warning"),
            f"count(*) FILTER ({c} > TIMESTAMP '2000-01-01')", source=f"({STAFF})")
        for c in ("hire_date", "birth_date")
    ),
)
def _(t):
    df = t.sql(STAFF)
    return rounded(validate.run_checks(df, validate.future_checks(df, AS_OF)))


@query(
    "check_old",
    " UNION ALL ".join(
        row("quality", "old_date", c, flag(f"min({c}) < TIMESTAMP '1900-01-01'", "warning"),
            f"count(*) FILTER ({c} < TIMESTAMP '1900-01-01')", source=f"({STAFF})")
        for c in ("hire_date", "seen_date", "birth_date")
    ),
)
def _(t):
    df = t.sql(STAFF)
    return rounded(validate.run_checks(df, validate.old_checks(df)))


def rule_sql(name, columns, broken, source):
    x = f"count(*) FILTER (coalesce({broken}, false))"
    return row("rules", name, columns, flag(f"{x} > 0", "failed"), x, share(x), source)


RANGES = {
    "quantity_range": {"type": "range", "column": "quantity", "min": 3, "max": 48},
    "price_range": {"type": "range", "column": "price", "min": 0, "max": 10_000_000},
    "absent": {"type": "range", "column": "no_such_column", "min": 0, "max": 1},
}


@query(
    "rule_range",
    " UNION ALL ".join(
        [
            rule_sql("quantity_range", "quantity", "quantity < 3 OR quantity > 48", "{gappy}"),
            rule_sql("price_range", "price", "price < 0 OR price > 10000000", "{gappy}"),
            row("rules", "absent", "no_such_column", "'skipped'"),
        ]
    ),
)
def _(t):
    return rounded(validate.run_checks(t.gappy, validate.rule_checks(t.gappy, RANGES)))


CATEGORY = {"type": "categorical", "column": "flag", "valid_values": ["A", "R"]}


@query("rule_categorical", rule_sql("flag_known", "flag", "NOT coalesce(flag IN ('A', 'R'), false)", "{gappy}"))
def _(t):
    return rounded(validate.run_checks(t.gappy, validate.rule_checks(t.gappy, {"flag_known": CATEGORY})))


@query(
    "rule_invalid_values",
    "SELECT flag AS value, count(*) AS rows FROM {gappy} WHERE NOT coalesce(flag IN ('A', 'R'), false) GROUP BY flag",
)
def _(t):
    return validate.invalid_values(t.gappy, CATEGORY)


CODES = {"type": "categorical", "column": "status", "valid_values": ["O"]}
BROKEN_RULES = {"flag_known": CATEGORY, "status_known": CODES, "quantity_range": RANGES["quantity_range"]}


@query(
    "report_invalid_values",
    " UNION ALL ".join(
        f"""SELECT 'lineas' AS dataset, 'invalid' AS part, '{name}' AS "check", {c} AS "column", 'failed' AS status, CAST(count(*) AS DOUBLE) AS value,
 {r("count(*) * 100.0 / (SELECT count(*) FROM {gappy})", 2)} AS pct FROM {{gappy}} WHERE NOT coalesce({c} IN ({valid}), false) GROUP BY {c}""".replace("FROM {gappy})", "FROM lineitem)")
        for name, c, valid in (("flag_known", "flag", "'A', 'R'"), ("status_known", "status", "'O'"))
    ),
)
def _(t):
    """The values that rules refuse, in the report of the table itself."""
    report = validate.validation_report(t.gappy, {"business_rules": BROKEN_RULES}, "lineas", as_of=datetime(2024, 11, 16))
    return rounded(report.where("part = 'invalid'"), 2)


RELATIONS = {
    f"rel_{i}": {"type": "relationship", "column1": "quantity", "column2": "l_linenumber", "operator": o}
    for i, o in enumerate((">", "<", ">=", "<="))
}


@query(
    "rule_relationship",
    " UNION ALL ".join(
        rule_sql(f"rel_{i}", "quantity l_linenumber", f"quantity {o} l_linenumber", "{gappy}")
        for i, o in enumerate(("<=", ">=", "<", ">"))
    ),
)
def _(t):
    return rounded(validate.run_checks(t.gappy, validate.rule_checks(t.gappy, RELATIONS)))


MIXED = {
    "text_range": {"type": "range", "column": "flag", "min": 1, "max": 5},
    "text_relation": {"type": "relationship", "column1": "flag", "column2": "quantity", "operator": ">"},
    "number_codes": {"type": "categorical", "column": "flag", "valid_values": [1, 2]},
    "quantity_range": RANGES["quantity_range"],
}


@query(
    "rule_error",
    " UNION ALL ".join(
        [
            row("rules", "text_range", "flag", "'error'"),
            row("rules", "text_relation", "flag quantity", "'error'"),
            rule_sql("number_codes", "flag", "true", "{gappy}"),
            rule_sql("quantity_range", "quantity", "quantity < 3 OR quantity > 48", "{gappy}"),
        ]
    ),
)
def _(t):
    return rounded(validate.run_checks(t.gappy, validate.rule_checks(t.gappy, MIXED)))


WIDTHS = {"l_orderkey": "int64", "l_linenumber": "int64", "l_partkey": "int32", "l_suppkey": "int", "l_quantity": "float32"}


@query(
    "schema_widths",
    " UNION ALL ".join(
        [
            row("schema", "type", "l_orderkey", "'passed'", "0", "0"),
            row("schema", "type", "l_linenumber", "'warning'", "0", "0"),
            row("schema", "type", "l_partkey", "'warning'", "count(*) FILTER (abs(l_partkey) >= 2147483648)",
                share("count(*) FILTER (abs(l_partkey) >= 2147483648)"), "lineitem"),
            row("schema", "type", "l_suppkey", "'passed'", "0", "0"),
            row("schema", "type", "l_quantity", "'warning'", "0", "0"),
        ]
    ),
)
def _(t):
    df = t.lineitem.select(*WIDTHS)
    return rounded(validate.run_checks(df, validate.schema_checks(df, WIDTHS)))


@query(
    "rules_status",
    """SELECT CASE WHEN count(*) FILTER (quantity < 3 OR quantity > 48) > 0 OR count(*) FILTER (price < 0) > 0
 THEN 'failed' ELSE 'passed' END AS status FROM {gappy}""",
)
def _(t):
    return validate.rules_status(validate.run_checks(t.gappy, validate.rule_checks(t.gappy, RANGES)))


REQUIRED = ["quantity", "price", "flag", "status"]


def completeness_sql(source: str) -> str:
    parts = [
        row("completeness", "completeness", c, flag(f"count({c}) * 100.0 / count(*) < 80", "warning"),
            f"count({c})", share(f"count({c})"), source)
        for c in REQUIRED
    ]
    total = " + ".join(f"count({c}) * 100.0 / count(*)" for c in REQUIRED)
    parts.append(row("completeness", "completeness", "absent", "'failed'", "0", "0"))
    parts.append(row("completeness", "score", None, "'passed'", f"round_even(({total}) / 5 * 100.0, 0) / 100.0", source=source))
    return " UNION ALL ".join(parts)


@query("completeness", completeness_sql("{gappy}"))
def _(t):
    checks = validate.completeness_checks(t.gappy, [*REQUIRED, "absent"])
    return rounded(validate.run_checks(t.gappy, checks))


def _reports(t):
    """Reports of three datasets, as a run appends them to one table."""
    first = validate.validation_report(
        t.profiles, {"business_rules": {"age": {"type": "range", "column": "edad", "min": 18, "max": 70}}}, "perfiles", as_of=AS_OF
    )
    second = validate.validation_report(
        t.orders, {"required_columns": ["o_orderkey", "o_custkey"], "schema": {"o_orderkey": "int64"}}, "empleos", as_of=AS_OF
    )
    third = validate.validation_report(t.sql(PROFILED), {}, "inversiones", as_of=AS_OF)
    return first.unionByName(second).unionByName(third)


@query(
    "overall_status",
    """SELECT 'perfiles' AS dataset, CASE WHEN count(*) FILTER (edad < 18 OR edad > 70) > 0 THEN 'failed' ELSE 'passed' END AS status FROM {profiles}
 UNION ALL SELECT 'empleos', 'passed'
 UNION ALL SELECT 'inversiones', CASE WHEN least(count(quantity), count(price), count(flag), count(mostly_null)) * 100.0 / count(*) < 80
 THEN 'warning' ELSE 'passed' END FROM (SELECT quantity, price, flag, CASE WHEN l_orderkey % 3 = 0 THEN l_orderkey END AS mostly_null FROM {gappy})""",
)
def _(t):
    return _reports(t).where("part = 'overall'").select("dataset", "status")


WORDS = "CASE {x} WHEN 'passed' THEN 'APROBADO' WHEN 'warning' THEN 'ADVERTENCIA' WHEN 'failed' THEN 'FALLIDO' ELSE upper({x}) END"
PAIR = "SELECT quantity, flag FROM {gappy}"
REPORT_RULES = {"quantity_range": RANGES["quantity_range"]}


@query(
    "report_long",
    f"""WITH d AS ({PAIR}) SELECT 'inversiones' AS dataset, *, {WORDS.format(x="status")} AS estado FROM (
 {row("quality", "min_rows", None, flag("count(*) < 100", "failed"), "count(*)", source="d")} UNION ALL
 {row("quality", "missing", "quantity", flag("count(quantity) * 2 < count(*)", "warning"), "count(*) - count(quantity)", share("count(*) - count(quantity)"), "d")} UNION ALL
 {row("quality", "missing", "flag", flag("count(flag) * 2 < count(*)", "warning"), "count(*) - count(flag)", share("count(*) - count(flag)"), "d")} UNION ALL
 {row("quality", "large", "quantity", flag("max(quantity) > 1000000", "warning"), "max(quantity)", source="d")} UNION ALL
 {rule_sql("quantity_range", "quantity", "quantity < 3 OR quantity > 48", "d")} UNION ALL
 {row("completeness", "completeness", "quantity", flag("count(quantity) * 100.0 / count(*) < 80", "warning"), "count(quantity)", share("count(quantity)"), "d")} UNION ALL
 {row("completeness", "completeness", "flag", flag("count(flag) * 100.0 / count(*) < 80", "warning"), "count(flag)", share("count(flag)"), "d")} UNION ALL
 {row("completeness", "score", None, "'passed'", "round_even((count(quantity) * 100.0 / count(*) + count(flag) * 100.0 / count(*)) / 2 * 100.0, 0) / 100.0", source="d")} UNION ALL
 {row("quality", "duplicates", None, flag("(sum(c) - count(*)) * 100.0 / sum(c) > 5", "warning"), "sum(c) - count(*)", "(sum(c) - count(*)) * 100.0 / sum(c)", "(SELECT count(*) AS c FROM d GROUP BY quantity, flag)")} UNION ALL
 {row("overall", "status", None, "CASE WHEN count(*) FILTER (quantity < 3 OR quantity > 48) > 0 THEN 'failed' WHEN least(count(quantity), count(flag)) * 100.0 / count(*) < 80 THEN 'warning' ELSE 'passed' END", source="d")})""",
)
def _(t):
    report = validate.validation_report(t.sql(PAIR), {"business_rules": REPORT_RULES}, "inversiones", as_of=AS_OF)
    return rounded(validate.translate_status(report))


@query(
    "quality_band",
    f"""WITH s AS (SELECT avg(x) AS score FROM (
 SELECT (count(quantity) + count(flag)) * 100.0 / 2 / count(*) AS x FROM ({PAIR})
 UNION ALL SELECT 100.0 FROM (SELECT count(*) FROM orders)
 UNION ALL SELECT (count(edad) + count(salario_actual_usd)) * 100.0 / 2 / count(*) FROM {{profiles}}))
 SELECT {r("score", 2)} AS score, CASE WHEN score > 90 THEN 'EXCELENTE' WHEN score > 80 THEN 'BUENO'
 WHEN score > 70 THEN 'REGULAR' ELSE 'NECESITA_MEJORA' END AS band FROM s""",
)
def _(t):
    reports = (
        validate.validation_report(t.sql(PAIR), {}, "inversiones", as_of=AS_OF)
        .unionByName(validate.validation_report(t.orders, {}, "empleos", as_of=AS_OF))
        .unionByName(validate.validation_report(t.profiles.select("edad", "salario_actual_usd"), {}, "perfiles", as_of=AS_OF))
    )
    return rounded(validate.quality_score(reports), 2)


@query(
    "dedup_delta",
    """SELECT CAST(sum(c) AS BIGINT) AS rows_in, count(*) AS rows_out, CAST(sum(c) - count(*) AS BIGINT) AS removed FROM (SELECT count(*) AS c FROM {copied}
 GROUP BY o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)""",
)
def _(t):
    return clean.duplicate_counts(t.copied)
