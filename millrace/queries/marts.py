"""BI table queries, on the unified fact of the three inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import bands as B
from millrace.operators import marts, mining
from millrace.queries.base import query, r, rounded
from millrace.queries.transform import band_sql
from millrace.queries.warehouse import FACT, RUN, fact, stored_fact


@query(
    "bi_main_bands",
    f"""SELECT id_registro, coalesce({band_sql("coalesce(salario_usd, 0)", B.BI_SALARY, True)}, 'nan') AS categoria_salario,
 coalesce({band_sql("coalesce(edad, 30)", B.BI_AGE, True)}, 'nan') AS grupo_edad, 2024 AS anio, 11 AS mes FROM ({FACT})""",
)
def _(t):
    main = marts.main_table(fact(t), RUN.year, RUN.month)
    return main.select("id_registro", "categoria_salario", "grupo_edad", "anio", "mes")


def _kpi(name, value, category, form, source=f"({FACT})", places=4):
    return f"SELECT '{name}' AS \"KPI\", {r(value, places)} AS \"Valor\", '{category}' AS \"Categoria\", '{form}' AS \"Formato\" FROM {source}"


@query(
    "kpi_table",
    " UNION ALL ".join(
        [
            _kpi("Total Registros", "count(*)", "Volumen", "Entero"),
            _kpi("Países Únicos", "count(DISTINCT pais_normalizado)", "Geografía", "Entero"),
            _kpi("Ciudades Únicas", "count(DISTINCT ciudad_normalizada)", "Geografía", "Entero"),
            _kpi("Salario Promedio", "avg(salario_usd)", "Compensación", "Moneda"),
            _kpi("Salario Mediano", "median(salario_usd)", "Compensación", "Moneda"),
            _kpi("Salario Máximo", "max(salario_usd)", "Compensación", "Moneda"),
            _kpi("Clusters Identificados", "5", "Análisis ML", "Entero", "(SELECT 1)"),
            _kpi("Precisión Modelo ML", "0.71", "Análisis ML", "Porcentaje", "(SELECT 1)"),
            f"""SELECT concat('Registros ', fuente_datos), {r("count(*)", 4)}, 'Fuentes', 'Entero' FROM ({FACT}) GROUP BY fuente_datos""",
        ]
    ),
)
def _(t):
    return rounded(marts.kpi_table(fact(t), {"clusters": 5, "accuracy": 0.71}), 4)


# Profiles with a fixed cluster number, and their cluster profile.
ASSIGNED = f"""SELECT id_registro, edad, salario_usd, pais_normalizado,
 CAST(CAST(substr(id_registro, 5) AS BIGINT) % 5 + 1 AS INT) AS cluster FROM ({FACT}) WHERE fuente_datos = 'perfiles_habilidades'"""
PROFILE = f"""SELECT cluster, count(*) AS cantidad_perfiles,
 {r("count(*) * 100.0::DOUBLE / (SELECT count(*) FROM profiles_assigned)", 2)} AS porcentaje,
 {r("avg(edad)", 2)} AS edad_promedio, {r("avg(salario_usd)", 2)} AS salario_promedio,
 (SELECT pais_normalizado FROM profiles_assigned b WHERE b.cluster = a.cluster GROUP BY pais_normalizado
  ORDER BY count(*) DESC, pais_normalizado LIMIT 1) AS pais_predominante FROM profiles_assigned a GROUP BY cluster"""
WITH_ASSIGNED = f"WITH profiles_assigned AS ({ASSIGNED})"


def assigned(t):
    people = fact(t).where("fuente_datos = 'perfiles_habilidades'")
    number = (F.substring("id_registro", 5, 20).cast("long") % 5 + 1).cast("int")
    return people.select("id_registro", "edad", "salario_usd", "pais_normalizado", number.alias("cluster"))


CLUSTER_SQL = f"""SELECT cluster AS "Cluster_ID", concat('Cluster_', cluster) AS "Cluster_Nombre", edad_promedio AS "Edad_Promedio",
 salario_promedio AS "Salario_Promedio", pais_predominante AS "Pais_Predominante", cantidad_perfiles AS "Cantidad_Perfiles",
 porcentaje AS "Porcentaje_Total", CASE WHEN salario_promedio >= 80000 THEN 'Premium' WHEN salario_promedio >= 50000 THEN 'Alto'
 WHEN salario_promedio >= 25000 THEN 'Medio' ELSE 'Emergente' END AS "Categoria_Cluster" FROM ({PROFILE})"""


@query("cluster_category", f"{WITH_ASSIGNED} {CLUSTER_SQL}")
def _(t):
    return rounded(marts.cluster_table(mining.cluster_profile(assigned(t))), 2)


GEO = f"""SELECT pais_normalizado, count(salario_usd) AS "Total_Empleos", {r("avg(salario_usd)", 2)} AS "Salario_Promedio",
 {r("median(salario_usd)", 2)} AS "Salario_Mediano", {r("avg(edad)", 2)} AS "Edad_Promedio",
 count(id_registro) AS "Total_Registros" FROM ({FACT}) GROUP BY pais_normalizado"""
REGION = "CASE " + " ".join(f"WHEN pais_normalizado = '{c}' THEN '{g}'" for c, g in marts.REGIONS.items()) + " ELSE 'Otro' END"
GEO_RANKED = f"""SELECT *, {REGION} AS "Region",
 dense_rank() OVER (ORDER BY "Salario_Promedio" DESC NULLS LAST) AS "Ranking_Salario" FROM ({GEO})"""


@query("geo_aggregate", GEO_RANKED)
def _(t):
    return rounded(marts.geography_table(fact(t)), 2)


@query(
    "region_lookup", f"SELECT id_registro, pais_normalizado, {REGION} AS \"Region\" FROM ({FACT})"
)
def _(t):
    return marts.add_region(fact(t).select("id_registro", "pais_normalizado"))


@query(
    "dense_rank_salary",
    """SELECT c_mktsegment, c_nationkey, "Salario_Promedio", dense_rank() OVER (ORDER BY "Salario_Promedio" DESC NULLS LAST) AS "Ranking_Salario"
 FROM (SELECT c_mktsegment, c_nationkey, CASE WHEN c_nationkey % 7 = 0 THEN NULL ELSE CAST(max(CAST(c_acctbal / 100 AS BIGINT)) AS DOUBLE) END AS "Salario_Promedio"
 FROM customer GROUP BY c_mktsegment, c_nationkey)""",
)
def _(t):
    top = F.when(F.col("c_nationkey") % 7 != 0, F.max(F.rint(F.col("c_acctbal") / 100)))
    means = t.customer.groupBy("c_mktsegment", "c_nationkey").agg(top.alias("Salario_Promedio"))
    return marts.add_salary_rank(means)


def tech_sql(column: str, kind: str) -> str:
    return f"""SELECT {column} AS "Tecnologia", '{kind}' AS "Tipo", count(*) AS "Total_Menciones",
 {r("coalesce(avg(salario_usd), 0)", 4)} AS "Salario_Promedio", {r("coalesce(median(salario_usd), 0)", 4)} AS "Salario_Mediano",
 row_number() OVER (ORDER BY count(*) DESC, {column}) AS "Popularidad_Rank" FROM ({FACT})
 WHERE {column} IS NOT NULL AND {column} <> 'Unknown' AND NOT contains({column}, '|') GROUP BY {column}"""


TECH = f"{tech_sql('tecnologia_principal', 'Lenguaje')} UNION ALL {tech_sql('framework_herramienta', 'Framework')}"


@query("tech_popularity", TECH)
def _(t):
    return rounded(marts.technology_popularity(fact(t)), 4)


@query("technology_table", f"""SELECT * FROM ({TECH}) WHERE "Popularidad_Rank" <= 15""")
def _(t):
    return rounded(marts.technology_table(fact(t)), 4)


@query(
    "top_n_per_group",
    """SELECT c_mktsegment, c_custkey, c_acctbal FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS n
 FROM customer) WHERE n <= 15""",
)
def _(t):
    rows = t.customer.select("c_mktsegment", "c_custkey", "c_acctbal")
    return marts.top_per_group(rows, "c_mktsegment", "c_acctbal", "c_custkey", 15)


# Periods follow the date of the record; profiles and programmes have none.
DATED = f"""SELECT fecha_referencia, salario_usd, CASE WHEN salario_usd IS NOT NULL THEN CAST(length(id_registro) * 3.17 AS DOUBLE) END AS edad,
 CASE WHEN anio_referencia % 2 = 0 THEN cargo_area ELSE id_registro END AS id_registro FROM ({FACT}) WHERE fecha_referencia IS NOT NULL"""


def dated(t):
    ids = F.when(F.col("anio_referencia") % 2 == 0, F.col("cargo_area")).otherwise(F.col("id_registro"))
    age = F.when(F.col("salario_usd").isNotNull(), F.length("id_registro") * F.lit(3.17))
    return fact(t).select("fecha_referencia", "salario_usd", age.alias("edad"), ids.alias("id_registro"))


YEARS = f"""SELECT concat('Año ', CAST(year(fecha_referencia) AS VARCHAR)) AS "Periodo", 'Anual' AS "Tipo_Periodo", count(salario_usd) AS "Total_Empleos",
 {r("avg(salario_usd)", 2)} AS "Salario_Promedio", {r("median(salario_usd)", 2)} AS "Salario_Mediano", {r("avg(edad)", 2)} AS "Edad_Promedia",
 count(DISTINCT id_registro) AS "Registros_Unicos" FROM ({DATED}) GROUP BY year(fecha_referencia)"""
QUARTERS = f"""SELECT concat('Q', CAST(quarter(fecha_referencia) AS VARCHAR), '-', CAST(year(fecha_referencia) AS VARCHAR)) AS "Periodo", 'Trimestral' AS "Tipo_Periodo",
 count(salario_usd) AS "Total_Empleos", {r("avg(salario_usd)", 2)} AS "Salario_Promedio", 0.0::DOUBLE AS "Salario_Mediano", 0.0::DOUBLE AS "Edad_Promedia",
 count(DISTINCT id_registro) AS "Registros_Unicos" FROM ({DATED}) GROUP BY year(fecha_referencia), quarter(fecha_referencia)"""


@query("metrics_year", YEARS)
def _(t):
    return rounded(marts.yearly_metrics(dated(t), "fecha_referencia"), 2)


@query("metrics_quarter", QUARTERS)
def _(t):
    return rounded(marts.quarterly_metrics(dated(t), "fecha_referencia"), 2)


@query("metrics_period_union", f"{YEARS} UNION ALL {QUARTERS}")
def _(t):
    return rounded(marts.period_table(dated(t), "fecha_referencia"), 2)


@query(
    "export_summary",
    f"""{WITH_ASSIGNED} SELECT 6::BIGINT AS datasets_created, CAST(sum(n) AS BIGINT) AS total_records FROM (
 SELECT count(*) AS n FROM ({FACT}) UNION ALL SELECT 9 + count(DISTINCT fuente_datos) - 1 FROM ({FACT})
 UNION ALL SELECT count(*) FROM ({PROFILE}) UNION ALL SELECT count(*) FROM ({GEO})
 UNION ALL SELECT count(*) FROM ({TECH}) WHERE "Popularidad_Rank" <= 15
 UNION ALL SELECT count(*) FROM ({YEARS}) UNION ALL SELECT count(*) FROM ({QUARTERS}))""",
)
def _(t):
    tables = marts.bi_tables(
        stored_fact(t), RUN, mining.cluster_profile(assigned(t)), {"clusters": 5, "accuracy": 0.71}, "fecha_referencia"
    )
    return marts.export_summary(tables)
