"""Transformation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import bands as B
from millrace.functions.text import TECH_KEYWORDS
from millrace.operators import transform
from millrace.queries.base import query, r, rounded


def band_sql(x: str, bands: B.Bands, include_lowest: bool = False) -> str:
    parts, low = [], bands.edges[0]
    above = f"{x} >= {low}" if include_lowest else f"{x} > {low}"
    for high, label in zip(bands.edges[1:], bands.labels, strict=True):
        top = "" if high == float("inf") else f" AND {x} <= {high}"
        parts.append(f"WHEN {above}{top} THEN '{label}'")
    return f"CASE {' '.join(parts)} END"


@query(
    "normalize_names",
    """SELECT c_custkey AS customer_key, c_name AS nombre_completo, c_nationkey AS "país",
 c_acctbal AS saldo_usd, c_mktsegment AS "año_segmento" FROM customer""",
)
def _(t):
    messy = t.customer.toDF("Customer Key", "Nombre  Completo!", "País", "Saldo (USD)", "_Año Segmento_")
    return transform.normalize_names(messy)


@query("band_right_closed", f"SELECT p_partkey, p_size, {band_sql('p_size', B.AGE_GROUP)} AS age_group FROM part")
def _(t):
    return transform.add_band(t.part.select("p_partkey", "p_size"), "p_size", B.AGE_GROUP, "age_group")


@query(
    "band_open_top",
    f"SELECT o_orderkey, {band_sql('o_totalprice', B.SALARY_RANGE)} AS salary_range FROM orders",
)
def _(t):
    banded = transform.add_band(t.orders, "o_totalprice", B.SALARY_RANGE, "salary_range")
    return banded.select("o_orderkey", "salary_range")


@query(
    "date_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS o_orderdate_year,
 CAST(month(o_orderdate) AS INT) AS o_orderdate_month, CAST(quarter(o_orderdate) AS INT) AS o_orderdate_quarter
 FROM orders""",
)
def _(t):
    return transform.date_parts(t.orders.select("o_orderkey", "o_orderdate")).drop("o_orderdate")


@query(
    "one_hot",
    "SELECT l_orderkey, l_partkey, l_linenumber, flag, coalesce(flag = 'N', false) AS \"flag_N\", coalesce(flag = 'R', false) AS \"flag_R\" FROM {gappy}",
)
def _(t):
    return transform.one_hot(t.gappy.select("l_orderkey", "l_partkey", "l_linenumber", "flag"), "flag")


@query(
    "label_encode",
    """SELECT job_key, lenguaje, CASE WHEN lenguaje IS NULL THEN -1 ELSE
 CAST(dense_rank() OVER (PARTITION BY lenguaje IS NULL ORDER BY lenguaje) - 1 AS INT) END AS lenguaje_encoded FROM {jobs}""",
)
def _(t):
    return transform.label_encode(t.jobs.select("job_key", "lenguaje"), "lenguaje")


@query(
    "label_encode_many",
    """SELECT o_orderkey, o_custkey, CAST(dense_rank() OVER (ORDER BY o_custkey) - 1 AS INT) AS o_custkey_encoded FROM orders""",
)
def _(t):
    return transform.label_encode(t.orders.select("o_orderkey", "o_custkey"), "o_custkey")


@query(
    "target_encode",
    f"""SELECT job_key, lenguaje, {r("CASE WHEN lenguaje IS NOT NULL THEN avg(salario_anual_usd) OVER (PARTITION BY lenguaje) END", 4)} AS lenguaje_target_encoded
 FROM {{jobs}}""",
)
def _(t):
    jobs = t.jobs.select("job_key", "lenguaje", "salario_anual_usd")
    return rounded(transform.target_encode(jobs, "lenguaje", "salario_anual_usd").drop("salario_anual_usd"), 4)


@query(
    "group_agg",
    f"""SELECT flag, status, {r("avg(quantity)")} AS quantity_mean, {r("coalesce(sum(quantity), 0)")} AS quantity_sum,
 count(quantity) AS quantity_count, {r("median(quantity)")} AS quantity_median, {r("stddev_samp(quantity)")} AS quantity_std,
 min(price) AS price_min, max(price) AS price_max, {r("var_samp(price)", 0)} AS price_var, {r("median(price)")} AS price_median,
 count(DISTINCT l_partkey) AS l_partkey_nunique, count(*) AS l_partkey_size,
 first(quantity ORDER BY shipped, l_orderkey, l_partkey, l_linenumber) FILTER (quantity IS NOT NULL) AS quantity_first,
 last(quantity ORDER BY shipped, l_orderkey, l_partkey, l_linenumber) FILTER (quantity IS NOT NULL) AS quantity_last
 FROM {{gappy}} WHERE flag IS NOT NULL GROUP BY flag, status""",
)
def _(t):
    grouped = transform.aggregate(
        t.gappy,
        ["flag", "status"],
        {
            "quantity": ["mean", "sum", "count", "median", "std", "first", "last"],
            "price": ["min", "max", "var", "median"],
            "l_partkey": ["nunique", "size"],
        },
        [F.col(c) for c in ("shipped", "l_orderkey", "l_partkey", "l_linenumber")],
    )
    return rounded(grouped.withColumn("price_var", F.rint("price_var")))


STATS = "(SELECT {f}(l_extendedprice{p}) FROM lineitem)"


@query(
    "norm_min_max",
    f"""SELECT l_orderkey, l_partkey, l_linenumber, {r("(l_extendedprice - lo) / (hi - lo)")} AS l_extendedprice_normalized
 FROM lineitem, (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)""",
)
def _(t):
    return _scaled(t, "min_max")


@query(
    "norm_z_score",
    f"""SELECT l_orderkey, l_partkey, l_linenumber, {r("(l_extendedprice - m) / s")} AS l_extendedprice_normalized
 FROM lineitem, (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM lineitem)""",
)
def _(t):
    return _scaled(t, "z_score")


@query(
    "norm_robust",
    f"""SELECT l_orderkey, l_partkey, l_linenumber, {r("(l_extendedprice - q[2]) / (q[3] - q[1])")} AS l_extendedprice_normalized
 FROM lineitem, (SELECT quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]) AS q FROM lineitem)""",
)
def _(t):
    return _scaled(t, "robust")


def _scaled(t, method):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    return rounded(transform.scale(rows, ["l_extendedprice"], method).drop("l_extendedprice"))


SIZE_BINS = B.Bands((1, 10, 20, 50), ("small", "mid", "big"))


@query(
    "bin_edges",
    f"SELECT p_partkey, p_size, {band_sql('p_size', SIZE_BINS, True)} AS p_size_binned FROM part",
)
def _(t):
    return transform.bin_edges(t.part.select("p_partkey", "p_size"), "p_size", SIZE_BINS.edges, SIZE_BINS.labels)


@query(
    "bin_equal_width",
    """SELECT job_key, CASE WHEN x IS NOT NULL THEN CAST(least(6, greatest(0, ceil((x - lo) / ((hi - lo) / 7.0)) - 1)) AS INT) END AS salario_anual_usd_binned
 FROM (SELECT job_key, salario_anual_usd AS x FROM {jobs}),
 (SELECT min(salario_anual_usd) AS lo, max(salario_anual_usd) AS hi FROM {jobs})""",
)
def _(t):
    jobs = t.jobs.select("job_key", "salario_anual_usd")
    return transform.bin_equal_width(jobs, "salario_anual_usd", 7).drop("salario_anual_usd")


@query(
    "bin_quantile",
    """SELECT person_key, CASE WHEN x IS NULL THEN NULL WHEN x <= q[2] THEN 'Q1' WHEN x <= q[3] THEN 'Q2' WHEN x <= q[4] THEN 'Q3'
 ELSE 'Q4' END AS salario_actual_usd_binned FROM (SELECT person_key, salario_actual_usd AS x FROM {profiles}),
 (SELECT quantile_cont(salario_actual_usd, [0, 0.25, 0.5, 0.75, 1]) AS q FROM {profiles})""",
)
def _(t):
    people = t.profiles.select("person_key", "salario_actual_usd")
    binned = transform.bin_quantile(people, "salario_actual_usd", 4, ["Q1", "Q2", "Q3", "Q4"])
    return binned.drop("salario_actual_usd")


# Two sides with null keys, unmatched keys and a column name in common.
LEFT = """SELECT CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE s_suppkey END AS supp, s_name AS name, s_acctbal FROM {supplier}"""
RIGHT = """SELECT CASE WHEN l_orderkey % 500 = 0 THEN NULL ELSE l_suppkey * 2 END AS supp, l_returnflag AS name,
 l_orderkey, l_partkey, l_linenumber FROM {lineitem}"""


def _merged(t, how):
    return transform.merge(t.sql(LEFT), t.sql(RIGHT), "supp", "supp", how, ("_l", "_r"))


def _merge_sql(key: str, join: str) -> str:
    return f"""SELECT {key} AS supp, a.name AS name_l, a.s_acctbal, b.name AS name_r, b.l_orderkey, b.l_partkey, b.l_linenumber
 FROM ({LEFT}) a {join} JOIN ({RIGHT}) b ON a.supp IS NOT DISTINCT FROM b.supp"""


@query("merge_inner", _merge_sql("a.supp", "INNER"))
def _(t):
    return _merged(t, "inner")


@query("merge_left", _merge_sql("a.supp", "LEFT"))
def _(t):
    return _merged(t, "left")


@query("merge_right", _merge_sql("b.supp", "RIGHT"))
def _(t):
    return _merged(t, "right")


@query("merge_outer", _merge_sql("coalesce(a.supp, b.supp)", "FULL"))
def _(t):
    return _merged(t, "outer")


@query("merge_cross", "SELECT p_partkey, p_brand, r_regionkey, r_name FROM part CROSS JOIN region")
def _(t):
    return transform.merge(t.part.select("p_partkey", "p_brand"), t.region, how="cross")


@query("text_length", "SELECT doc_id, CAST(length(text) AS INT) AS text_length FROM documents")
def _(t):
    return transform.text_features(t.documents, "text").select("doc_id", "text_length")


@query(
    "word_count",
    r"SELECT doc_id, CAST(len(regexp_extract_all(text, '[^\s\x0b\x1c-\x1f\x85\p{Z}]+')) AS INT) AS text_word_count FROM documents",
)
def _(t):
    return transform.text_features(t.documents, "text").select("doc_id", "text_word_count")


@query(
    "keyword_flags",
    "SELECT doc_id, "
    + ", ".join(f"contains(lower(text), '{k}') AS has_{k.replace(' ', '_')}" for k in TECH_KEYWORDS)
    + " FROM documents",
)
def _(t):
    flagged = transform.text_features(t.documents, "text")
    return flagged.select("doc_id", *[f"has_{k.replace(' ', '_')}" for k in TECH_KEYWORDS])


@query(
    "pivot_mean",
    "SELECT status, "
    + ", ".join(f"""{r(f"coalesce(avg(price) FILTER (flag = '{v}'), 0)", 4)} AS "{v}" """ for v in "ANR")
    + " FROM {gappy} WHERE price IS NOT NULL AND flag IS NOT NULL GROUP BY status",
)
def _(t):
    return rounded(transform.pivot(t.gappy, "status", "flag", "price", column_values=["A", "N", "R"]), 4)


@query(
    "pivot_sum_list",
    "SELECT status, "
    + ", ".join(
        f"""{r(f"coalesce(sum({m}) FILTER (flag = '{v}'), 0)", 2)} AS "{m}_{v}" """
        for m in ("quantity", "price")
        for v in "ANR"
    )
    + " FROM {gappy} WHERE flag IS NOT NULL GROUP BY status",
)
def _(t):
    return rounded(transform.pivot(t.gappy, "status", "flag", ["quantity", "price"], "sum"), 2)


@query(
    "transform_chain",
    f"""WITH d AS (SELECT c_custkey AS clave, CAST(c_custkey % 90 AS DOUBLE) AS edad, c_acctbal * 17.0137 AS salario,
 c_mktsegment AS segmento, c_name AS nombre FROM customer),
 s AS (SELECT min(salario) AS lo, max(salario) AS hi, quantile_cont(edad, [0, 0.25, 0.5, 0.75, 1]) AS q FROM d)
 SELECT clave, edad, salario, segmento, nombre, {band_sql("edad", B.AGE_GROUP)} AS edad_group,
 {band_sql("salario", B.SALARY_RANGE)} AS salario_range,
 CAST(dense_rank() OVER (ORDER BY segmento) - 1 AS INT) AS segmento_encoded,
 {r("(salario - lo) / (hi - lo)")} AS salario_normalized,
 CASE WHEN edad <= q[2] THEN 'a' WHEN edad <= q[3] THEN 'b' WHEN edad <= q[4] THEN 'c' ELSE 'd' END AS edad_binned,
 CAST(length(nombre) AS INT) AS nombre_length, 1 AS nombre_word_count,
 {", ".join(f"contains(lower(nombre), '{k}') AS has_{k.replace(' ', '_')}" for k in TECH_KEYWORDS)} FROM d, s""",
)
def _(t):
    people = t.sql(
        """SELECT c_custkey AS `Clave`, CAST(c_custkey % 90 AS DOUBLE) AS `Edad`, c_acctbal * 17.0137 AS `Salario!`,
 c_mktsegment AS `Segmento`, c_name AS `Nombre` FROM {customer}"""
    )
    changed = transform.transform_frame(
        people,
        {
            "age_column": "edad",
            "salary_column": "salario",
            "encoding": {"segmento": "label"},
            "normalization": {"columns": ["salario"], "method": "min_max"},
            "binning": {"edad": {"bins": 4, "labels": ["a", "b", "c", "d"], "method": "qcut"}},
            "text_features": ["nombre"],
        },
    )
    return changed.withColumn("salario_normalized", F.rint(F.col("salario_normalized") * 1e6) / 1e6 + 0.0)


@query(
    "merge_common_columns",
    """SELECT s.s_suppkey AS supp, s.s_name, l.l_orderkey, l.l_linenumber FROM {supplier} s
 JOIN {lineitem} l ON s.s_suppkey = l.l_suppkey""",
)
def _(t):
    left = t.supplier.selectExpr("s_suppkey AS supp", "s_name")
    right = t.lineitem.selectExpr("l_suppkey AS supp", "l_orderkey", "l_linenumber")
    return transform.merge(left, right)


@query(
    "pivot_many",
    "SELECT status, "
    + ", ".join(f"""{r(f"coalesce(median(price) FILTER (flag = '{v}'), 0)", 4)} AS "median_price_{v}", coalesce(max(price) FILTER (flag = '{v}'), 0) AS "max_price_{v}" """ for v in "ANR")
    + " FROM {gappy} WHERE price IS NOT NULL AND flag IS NOT NULL GROUP BY status",
)
def _(t):
    return rounded(transform.pivot(t.gappy, "status", "flag", "price", ["median", "max"], ["A", "N", "R"]), 4)
