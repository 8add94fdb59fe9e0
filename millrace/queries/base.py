"""Registry, table access and the inputs that play the roles of the three sources.

The given tables have no nulls, duplicates or messy text, so the inputs below derive them from
ids with integer arithmetic. Each is one SQL text that Spark and the comparison engine share.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numbers import round_half_even

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

COUNTRY = """CASE {key} % 9 WHEN 0 THEN 'USA' WHEN 1 THEN 'España' WHEN 2 THEN 'colombia'
 WHEN 3 THEN 'Argentina' WHEN 4 THEN 'chile' WHEN 5 THEN 'Perú' WHEN 6 THEN 'méxico'
 WHEN 7 THEN NULL ELSE concat('nation ', CAST({key} % 25 AS STRING)) END"""
CITY = """CASE WHEN {key} % 12 = 0 THEN NULL ELSE concat('villa o''', CAST({key} % 40 AS STRING), 'nova') END"""

INPUTS = {
    # line items with gaps
    "gappy": """SELECT l_orderkey, l_partkey, l_linenumber,
 CASE WHEN (l_orderkey + l_linenumber) % 7 = 0 THEN NULL ELSE l_quantity END AS quantity,
 CASE WHEN (l_orderkey + l_partkey) % 11 = 0 THEN NULL ELSE l_extendedprice END AS price,
 CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_returnflag END AS flag,
 l_linestatus AS status, l_shipdate AS shipped FROM {lineitem}""",
    # a tenth of the orders twice
    "copied": """SELECT * FROM {orders} UNION ALL SELECT * FROM {orders} WHERE o_orderkey % 10 = 0""",
    # job offers
    "jobs": f"""SELECT concat('JOB-', CAST(o_orderkey AS STRING)) AS id_oferta, o_orderkey AS job_key,
 concat('Empresa ', CAST(o_custkey % 40 AS STRING)) AS empresa, o_orderpriority AS cargo,
 {CITY.format(key="o_custkey")} AS ciudad, {COUNTRY.format(key="o_custkey")} AS pais,
 CASE o_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 'Unknown' WHEN 2 THEN 'Java|Go'
 WHEN 3 THEN 'python' WHEN 4 THEN 'Python' WHEN 5 THEN 'Python' WHEN 6 THEN 'Java' WHEN 7 THEN 'Go'
 WHEN 8 THEN 'Scala' ELSE concat('Lang', CAST(o_custkey % 20 AS STRING)) END AS lenguaje,
 CASE o_orderkey % 5 WHEN 0 THEN 'Spark' WHEN 1 THEN 'Django' WHEN 2 THEN 'React'
 WHEN 3 THEN concat('Fw', CAST(o_custkey % 17 AS STRING))
 ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'Unknown' ELSE 'Django' END END AS framework,
 CASE o_orderkey % 4 WHEN 0 THEN 'Junior' WHEN 1 THEN 'Senior' WHEN 2 THEN NULL ELSE 'Mid' END AS nivel_seniority,
 CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice * 0.3711 END AS salario_anual_usd,
 o_orderstatus AS modalidad, o_orderdate AS fecha_publicacion FROM {{orders}}""",
    # training programmes
    "investments": f"""SELECT concat('PRG-', CAST(l_orderkey AS STRING), '-', CAST(l_partkey AS STRING)) AS id_programa,
 concat('Org ', l_returnflag) AS organizacion, concat('Area ', l_linestatus) AS area_tecnologica,
 l_extendedprice AS inversion_usd,
 CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_quantity END AS participantes,
 CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS duracion_meses,
 CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE 3 + l_discount * 19.37 END AS satisfaccion_promedio,
 CAST(year(l_shipdate) AS INT) AS ano,
 {CITY.format(key="l_suppkey")} AS ciudad, {COUNTRY.format(key="l_suppkey")} AS pais FROM {{lineitem}}""",
    # skill profiles
    "profiles": f"""SELECT concat('PER-', CAST(c_custkey AS STRING)) AS id_persona, c_custkey AS person_key,
 CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE CAST(c_custkey % 61 AS DOUBLE) END AS edad,
 {CITY.format(key="c_nationkey")} AS ciudad, {COUNTRY.format(key="c_nationkey")} AS pais,
 CASE c_custkey % 7 WHEN 0 THEN 'Python|Java' WHEN 1 THEN 'Unknown' WHEN 2 THEN NULL WHEN 3 THEN 'Go'
 ELSE 'Python' END AS lenguajes_dominio,
 CASE c_custkey % 3 WHEN 0 THEN 'Spark' WHEN 1 THEN 'Django' ELSE 'Unknown' END AS frameworks_dominio,
 c_mktsegment AS certificaciones,
 CASE WHEN c_custkey % 16 = 15 THEN NULL ELSE CAST(c_custkey % 16 AS DOUBLE) END AS anos_experiencia,
 concat('Nivel ', CAST(c_custkey % 4 AS STRING)) AS nivel_educativo, c_mktsegment AS area_trabajo_actual,
 CASE WHEN c_custkey % 14 = 0 THEN NULL ELSE c_acctbal * 17.0137 END AS salario_actual_usd FROM {{customer}}""",
}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


class Tables:
    """The given tables of one folder, and the inputs derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name in INPUTS:
            return self.sql(INPUTS[name])
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        used = set(re.findall(r"\{(\w+)\}", text))
        return self.spark.sql(text, **{name: getattr(self, name) for name in used})


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round the doubles, so that the order of a sum leaves no trace in a comparison."""
    return df.select(
        *[
            (round_half_even(F.col(f"`{f.name}`"), places) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def r(expression: str, places: int = 6) -> str:
    """SQL twin of ``rounded``."""
    return f"(round_even(CAST({expression} AS DOUBLE) * 1e{places}, 0) / 1e{places} + 0.0)"


def plain_sql(text: str) -> str:
    """Replace ``{input}`` by its SELECT and ``{table}`` by the table name."""

    def fill(match: re.Match) -> str:
        name = match.group(1)
        return f"({plain_sql(INPUTS[name])})" if name in INPUTS else name

    return re.sub(r"\{(\w+)\}", fill, text)


def query(name: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under a name, with its SQL if there is one."""

    def register(function: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = plain_sql(sql)
        return function

    return register
