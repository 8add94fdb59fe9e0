"""Cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import clean
from millrace.queries.base import query, r, rounded

SPACES = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"


def clean_sql(x: str) -> str:
    return f"nullif(trim(regexp_replace({x}, '{SPACES}', ' ', 'g'), ' '), 'nan')"


def title_sql(x: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({x}), "
        r"'([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)'), lambda w: concat(upper(w[1]), w[2:])), '')"
    )


MESSY_TEXT = """SELECT doc_id, text,
 CASE WHEN doc_id % 9 = 0 THEN ' nan ' WHEN doc_id % 9 = 1 THEN NULL
 ELSE concat('  ', lang, chr(9), chr(160), ' ', source, ' ') END AS tag FROM {documents}"""


@query("clean_text", f"SELECT doc_id, {clean_sql('text')} AS text, {clean_sql('tag')} AS tag FROM ({MESSY_TEXT})")
def _(t):
    return clean.clean_text(t.sql(MESSY_TEXT), ["text", "tag"])


@query("dedup_full", "SELECT DISTINCT * FROM {copied}")
def _(t):
    return clean.drop_duplicates(t.copied)


@query(
    "dedup_subset",
    """SELECT l_partkey, l_orderkey, l_suppkey, l_linenumber, l_shipdate FROM
 (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_suppkey, l_linenumber) AS rn
  FROM lineitem) WHERE rn = 1""",
)
def _(t):
    rows = t.lineitem.select("l_partkey", "l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate")
    order = [F.col(c) for c in ("l_shipdate", "l_orderkey", "l_suppkey", "l_linenumber")]
    return clean.drop_duplicates(rows, ["l_partkey"], order)


PROFILED = """SELECT quantity, price, flag, status,
 CASE WHEN l_orderkey % 3 = 0 THEN l_orderkey END AS mostly_null FROM {gappy}"""


@query(
    "null_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS null_count,
 {r(f"(count(*) - count({c})) * 100.0 / count(*)")} AS null_pct,
 (count(*) - count({c})) * 100.0 / count(*) > 50 AS over_threshold FROM ({PROFILED})"""
        for c in ("quantity", "price", "flag", "status", "mostly_null")
    ),
)
def _(t):
    return rounded(clean.null_profile(t.sql(PROFILED)))


GAP_COLUMNS = "l_orderkey, l_partkey, l_linenumber"


def _filled(t, strategy):
    rows = t.gappy.select("l_orderkey", "l_partkey", "l_linenumber", *strategy)
    return rounded(clean.fill_missing(rows, strategy))


@query("fill_drop", f"SELECT {GAP_COLUMNS}, quantity FROM {{gappy}} WHERE quantity IS NOT NULL")
def _(t):
    return _filled(t, {"quantity": "drop"})


@query(
    "fill_mean",
    f"""SELECT {GAP_COLUMNS}, {r("coalesce(quantity, (SELECT avg(quantity) FROM {gappy}))", 4)} AS quantity,
 {r("coalesce(price, (SELECT avg(price) FROM {gappy}))", 4)} AS price, flag FROM {{gappy}}""",
)
def _(t):
    filled = clean.fill_missing(
        t.gappy.select("l_orderkey", "l_partkey", "l_linenumber", "quantity", "price", "flag"),
        {"quantity": "mean", "price": "mean", "flag": "mean"},
    )
    return rounded(filled, 4)


@query(
    "fill_median",
    f"""SELECT {GAP_COLUMNS}, {r("coalesce(quantity, (SELECT median(quantity) FROM {gappy}))")} AS quantity,
 {r("coalesce(price, (SELECT median(price) FROM {gappy}))")} AS price FROM {{gappy}}""",
)
def _(t):
    return _filled(t, {"quantity": "median", "price": "median"})


@query(
    "fill_mode",
    f"""SELECT {GAP_COLUMNS}, coalesce(flag, (SELECT flag FROM {{gappy}} WHERE flag IS NOT NULL
 GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1)) AS flag FROM {{gappy}}""",
)
def _(t):
    return _filled(t, {"flag": "mode"})


GAPPY_EVENTS = """SELECT event_id, user_id, ts,
 CASE WHEN event_id % 3 <> 0 THEN NULL ELSE value END AS value,
 CASE WHEN event_id % 4 = 1 THEN NULL ELSE event_type END AS event_type FROM {events}"""


@query(
    "fill_forward",
    f"""SELECT event_id, user_id, ts, last_value(value IGNORE NULLS) OVER w AS value,
 last_value(event_type IGNORE NULLS) OVER w AS event_type FROM ({GAPPY_EVENTS})
 WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def _(t):
    return clean.fill_missing(
        t.sql(GAPPY_EVENTS),
        {"value": "forward_fill", "event_type": "forward_fill"},
        [F.col("ts"), F.col("event_id")],
        ["user_id"],
    )


@query(
    "fill_forward_global",
    f"""SELECT event_id, user_id, ts, last_value(value IGNORE NULLS) OVER w AS value, event_type
 FROM ({GAPPY_EVENTS})
 WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def _(t):
    return clean.fill_missing(t.sql(GAPPY_EVENTS), {"value": "forward_fill"}, [F.col("ts"), F.col("event_id")])


@query(
    "fill_zero",
    f"SELECT {GAP_COLUMNS}, coalesce(quantity, 0.0::DOUBLE) AS quantity, flag FROM {{gappy}}",
)
def _(t):
    return _filled(t, {"quantity": "zero", "flag": "zero"})


@query("fill_unknown", f"SELECT {GAP_COLUMNS}, coalesce(flag, 'Unknown') AS flag FROM {{gappy}}")
def _(t):
    return _filled(t, {"flag": "unknown"})


MONEY = """SELECT o_orderkey, CASE o_orderkey % 8
 WHEN 0 THEN concat('USD ', CAST(o_custkey AS STRING))
 WHEN 1 THEN concat('US$ ', CAST(o_custkey % 90 + 10 AS STRING), '.', CAST(o_custkey % 900 + 100 AS STRING))
 WHEN 2 THEN concat('$', CAST(o_custkey % 90 + 10 AS STRING), ',', CAST(o_custkey % 900 + 100 AS STRING))
 WHEN 3 THEN concat('-', CAST(o_custkey AS STRING), ' €')
 WHEN 4 THEN '???' WHEN 5 THEN concat(CAST(o_custkey AS STRING), '-5') WHEN 6 THEN NULL
 ELSE CAST(o_custkey AS STRING) END AS money FROM {orders}"""


@query(
    "parse_currency",
    f"SELECT o_orderkey, try_cast(regexp_replace(money, '[^0-9.-]', '', 'g') AS DOUBLE) AS money FROM ({MONEY})",
)
def _(t):
    return clean.parse_currency(t.sql(MONEY), ["money"])


@query(
    "parse_currency_groups",
    f"""SELECT o_orderkey, try_cast(CASE WHEN o_orderkey % 8 = 1
 THEN regexp_replace(money, '[^0-9-]', '', 'g') ELSE regexp_replace(money, '[^0-9.-]', '', 'g') END AS DOUBLE) AS money
 FROM ({MONEY})""",
)
def _(t):
    return clean.parse_currency(t.sql(MONEY), ["money"], thousands=".")


SPIKED = """SELECT l_orderkey, l_partkey, l_linenumber, l_tax,
 CASE WHEN l_orderkey % 997 = 0 THEN l_extendedprice * 40 ELSE l_extendedprice END AS price,
 CASE WHEN l_partkey % 211 = 0 THEN l_quantity * 30 ELSE l_quantity END AS quantity,
 7 AS constant FROM {lineitem}"""


@query(
    "null_outliers",
    f"""SELECT l_orderkey, l_partkey, l_linenumber, l_tax,
 CASE WHEN abs(price - (SELECT avg(price) FROM ({SPIKED}))) > 3 * (SELECT stddev_samp(price) FROM ({SPIKED})) THEN NULL ELSE price END AS price,
 CASE WHEN abs(quantity - (SELECT avg(quantity) FROM ({SPIKED}))) > 3 * (SELECT stddev_samp(quantity) FROM ({SPIKED})) THEN NULL ELSE quantity END AS quantity,
 constant FROM ({SPIKED})""",
)
def _(t):
    return clean.clean_numeric(t.sql(SPIKED), ["price", "quantity", "constant"])


DATES = """SELECT o_orderkey, CASE o_orderkey % 5
 WHEN 0 THEN concat(CAST(year(o_orderdate) AS STRING), '-', lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '-', lpad(CAST(day(o_orderdate) AS STRING), 2, '0'))
 WHEN 1 THEN concat(lpad(CAST(day(o_orderdate) AS STRING), 2, '0'), '/', lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '/', CAST(year(o_orderdate) AS STRING))
 WHEN 2 THEN concat(CAST(year(o_orderdate) AS STRING), '/', lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '/', lpad(CAST(day(o_orderdate) AS STRING), 2, '0'))
 WHEN 3 THEN 'pronto' ELSE concat(CAST(year(o_orderdate) AS STRING), '-13-40') END AS published FROM {orders}"""


@query(
    "parse_dates",
    f"""SELECT o_orderkey, CAST(try_strptime(published, ['%Y-%m-%d', '%d/%m/%Y', '%Y/%m/%d', '%d-%m-%Y']) AS DATE) AS published
 FROM ({DATES})""",
)
def _(t):
    parsed = clean.standardize_dates(t.sql(DATES), ["published"])
    return parsed.withColumn("published", F.to_date("published"))


PRIORITIES = """SELECT o_orderkey,
 CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 6 = 1 THEN lower(o_orderpriority)
 ELSE o_orderpriority END AS priority, {city} AS place FROM {{orders}}""".format(
    city="concat('san JOSÉ de l''', CAST(o_custkey % 50 AS STRING), 'area')"
)


@query(
    "categorical_whitelist",
    f"""SELECT o_orderkey, CASE WHEN {title_sql("priority")} IN ('1-Urgent', '2-High', '3-Medium')
 THEN {title_sql("priority")} ELSE 'Other' END AS priority, {title_sql("place")} AS place FROM ({PRIORITIES})""",
)
def _(t):
    kept = clean.clean_categories(t.sql(PRIORITIES), "priority", ["1-URGENT", "2-high", "3-Medium"])
    return clean.clean_categories(kept, "place")


EMAILS = """SELECT c_custkey, CASE c_custkey % 5
 WHEN 0 THEN concat(' ', lower(c_mktsegment), CAST(c_custkey AS STRING), '@Mail.example.COM ')
 WHEN 1 THEN concat(c_name, '@example') WHEN 2 THEN concat('no at sign ', c_name) WHEN 3 THEN NULL
 ELSE concat('a.b+', CAST(c_custkey AS STRING), '@sub.example.org') END AS email FROM {customer}"""


@query(
    "clean_email",
    f"""SELECT c_custkey, CASE WHEN regexp_full_match(lower(trim(email)), '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{{{2,}}}}')
 THEN lower(trim(email)) END AS email FROM ({EMAILS})""".replace("{{", "{").replace("}}", "}"),
)
def _(t):
    return clean.clean_emails(t.sql(EMAILS), ["email"])


RAW_JOBS = """SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE concat(' ciudad  ', CAST(o_custkey % 30 AS STRING)) END AS city,
 concat('$', CAST(o_custkey AS STRING)) AS salary, CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE o_totalprice END AS total,
 o_orderpriority AS level, concat('u', CAST(o_custkey AS STRING), '@example.com') AS email,
 concat(CAST(year(o_orderdate) AS STRING), '-01-02') AS published FROM {orders}"""
RAW_TWICE = f"SELECT * FROM ({RAW_JOBS}) UNION ALL SELECT * FROM ({RAW_JOBS}) WHERE o_orderkey % 10 = 0"


@query(
    "clean_chain",
    f"""WITH d AS (SELECT DISTINCT * FROM ({RAW_TWICE})),
 f AS (SELECT *, coalesce(total, (SELECT median(total) FROM d)) AS filled, CAST(substr(salary, 2) AS DOUBLE) AS pay FROM d),
 s AS (SELECT avg(filled) AS mt, stddev_samp(filled) AS st, avg(pay) AS mp, stddev_samp(pay) AS sp FROM f)
 SELECT o_orderkey, {clean_sql("coalesce(city, 'Unknown')")} AS city,
 CASE WHEN abs(pay - mp) > 3 * sp THEN NULL ELSE pay END AS salary,
 {r("CASE WHEN abs(filled - mt) > 3 * st THEN NULL ELSE filled END")} AS total,
 CASE WHEN level IN ('1-URGENT', '2-HIGH') THEN {title_sql("level")} ELSE 'Other' END AS level,
 email, CAST(published AS DATE) AS published FROM f, s""",
)
def _(t):
    cleaned = clean.clean_frame(
        t.sql(RAW_TWICE),
        {
            "missing_strategy": {"city": "unknown", "total": "median", "salary": "median"},
            "text_columns": ["city"],
            "numeric_columns": ["salary", "total"],
            "date_columns": ["published"],
            "categorical_columns": {"level": ["1-Urgent", "2-High"]},
            "email_columns": ["email"],
        },
    )
    return rounded(cleaned.withColumn("published", F.to_date("published")))


DATETIMES = """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN concat(substr(CAST(o_orderdate AS STRING), 1, 10), ' 10:30:00')
 WHEN 1 THEN concat(substr(CAST(o_orderdate AS STRING), 1, 10), 'T23:05:09')
 ELSE concat(CAST(year(o_orderdate) AS STRING), '-', CAST(month(o_orderdate) AS STRING), '-', CAST(day(o_orderdate) AS STRING)) END AS published FROM {orders}"""


@query(
    "parse_datetimes",
    f"SELECT o_orderkey, strftime(try_strptime(published, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%d']), '%Y-%m-%d %H:%M:%S') AS published FROM ({DATETIMES})",
)
def _(t):
    parsed = clean.standardize_dates(t.sql(DATETIMES), ["published"])
    return parsed.withColumn("published", F.date_format("published", "yyyy-MM-dd HH:mm:ss"))


NANS = "SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 7 = 0 THEN CAST('NaN' AS DOUBLE) WHEN l_partkey % 5 = 0 THEN NULL ELSE l_quantity END AS quantity FROM {lineitem}"


@query(
    "nan_as_null",
    f"""WITH n AS (SELECT l_orderkey, l_linenumber, nullif(quantity, 'NaN'::DOUBLE) AS q FROM ({NANS}))
 SELECT l_orderkey, l_linenumber, {r("coalesce(q, (SELECT avg(q) FROM n))")} AS quantity FROM n""",
)
def _(t):
    return rounded(clean.fill_missing(t.sql(NANS), {"quantity": "mean"}))
