"""Warehouse queries: jobs from orders, investments from line items, profiles from customers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from millrace.functions import bands as B
from millrace.operators import warehouse as wh
from millrace.operators.transform import date_parts
from millrace.queries.base import query, r, rounded
from millrace.queries.clean import title_sql
from millrace.queries.transform import band_sql
from millrace.session import written

RUN = datetime(2024, 11, 16, 10, 30)
RUN_SQL = "TIMESTAMP '2024-11-16 10:30:00'"

N = "CAST(NULL AS VARCHAR)"
D = "CAST(NULL AS DOUBLE)"
UNIFIED = f"""SELECT 'empleos_tech' AS fuente_datos, {RUN_SQL} AS fecha_procesamiento, id_oferta AS id_registro,
 empresa AS empresa_organizacion, cargo AS cargo_area, ciudad, pais, lenguaje AS tecnologia_principal,
 framework AS framework_herramienta, nivel_seniority AS nivel_experiencia, salario_anual_usd AS salario_usd,
 modalidad AS modalidad_tipo, CAST(fecha_publicacion AS TIMESTAMP) AS fecha_referencia,
 CAST(year(fecha_publicacion) AS INT) AS anio_referencia, {D} AS edad, {D} AS anos_experiencia,
 {N} AS nivel_educativo, {N} AS certificaciones, {D} AS inversion_usd, {D} AS participantes, {D} AS duracion_meses,
 {D} AS satisfaccion_promedio FROM {{jobs}}
 UNION ALL SELECT 'inversiones_tech', {RUN_SQL}, id_programa, organizacion, area_tecnologica, ciudad, pais, NULL, NULL, NULL,
 NULL, NULL, NULL, ano, NULL, NULL, NULL, NULL, inversion_usd, participantes, duracion_meses, satisfaccion_promedio FROM {{investments}}
 UNION ALL SELECT 'perfiles_habilidades', {RUN_SQL}, id_persona, NULL, area_trabajo_actual, ciudad, pais, lenguajes_dominio,
 frameworks_dominio, NULL, salario_actual_usd, NULL, NULL, NULL, edad, anos_experiencia, nivel_educativo, certificaciones,
 NULL, NULL, NULL, NULL FROM {{profiles}}"""
FACT = f"""SELECT *, salario_usd IS NOT NULL AS tiene_salario, {band_sql("salario_usd", B.SALARY_RANGE)} AS rango_salario,
 anos_experiencia IS NOT NULL AS tiene_experiencia, {band_sql("anos_experiencia", B.EXPERIENCE)} AS nivel_experiencia_grupo,
 coalesce({title_sql("pais")}, 'No Especificado') AS pais_normalizado,
 coalesce({title_sql("ciudad")}, 'No Especificado') AS ciudad_normalizada,
 11 AS mes_procesamiento, 2024 AS ano_procesamiento FROM ({UNIFIED})"""


def unified(t):
    sources = [
        (date_parts(t.jobs), wh.JOBS_SOURCE),
        (t.investments, wh.INVESTMENTS_SOURCE),
        # accented names, as the name normalization leaves them
        (t.profiles.withColumnsRenamed({"pais": "país", "anos_experiencia": "años_experiencia"}), wh.PROFILES_SOURCE),
    ]
    return wh.unify(sources, RUN)


def fact(t):
    return wh.add_derived(unified(t))


def stored_fact(t):
    """The fact as a run stores it, for queries that read it several times."""
    return written(fact(t), "fact")


def ntz(df):
    """Wall-clock timestamps, as the comparison engine has them."""
    for name, kind in df.dtypes:
        if kind == "timestamp":
            df = df.withColumn(name, F.col(name).cast("timestamp_ntz"))
    return df


@query(
    "conform_columns",
    f"SELECT *, 'empleos_tech' AS fuente_datos, {RUN_SQL} AS fecha_procesamiento FROM {{jobs}}",
)
def _(t):
    return ntz(wh.conform(t.jobs.withColumnRenamed("pais", "país"), wh.JOBS, RUN))


@query("unify_sources", UNIFIED)
def _(t):
    return ntz(unified(t))


@query("presence_flags", f"SELECT id_registro, tiene_salario, tiene_experiencia FROM ({FACT})")
def _(t):
    return fact(t).select("id_registro", "tiene_salario", "tiene_experiencia")


@query("fact_salary_band", f"SELECT id_registro, salario_usd, rango_salario FROM ({FACT})")
def _(t):
    return fact(t).select("id_registro", "salario_usd", "rango_salario")


@query(
    "experience_band",
    f"SELECT id_registro, anos_experiencia, nivel_experiencia_grupo FROM ({FACT})",
)
def _(t):
    return fact(t).select("id_registro", "anos_experiencia", "nivel_experiencia_grupo")


@query("title_case_place", f"SELECT id_registro, pais_normalizado, ciudad_normalizada FROM ({FACT})")
def _(t):
    return fact(t).select("id_registro", "pais_normalizado", "ciudad_normalizada")


@query("processing_parts", f"SELECT id_registro, mes_procesamiento, ano_procesamiento FROM ({FACT})")
def _(t):
    return fact(t).select("id_registro", "mes_procesamiento", "ano_procesamiento")


@query("count_by_source", f"SELECT fuente_datos, count(*) AS registros FROM ({UNIFIED}) GROUP BY fuente_datos")
def _(t):
    return wh.counts_by(fact(t), "fuente_datos")


@query(
    "distinct_places",
    f"SELECT count(DISTINCT pais_normalizado) AS paises, count(DISTINCT ciudad_normalizada) AS ciudades FROM ({FACT})",
)
def _(t):
    return wh.distinct_places(fact(t))


def top_sql(column: str, k: int) -> str:
    return f"""SELECT {column}, count(*) AS registros FROM ({FACT}) WHERE {column} IS NOT NULL GROUP BY {column}
 ORDER BY registros DESC, {column} LIMIT {k}"""


@query(
    "top_k_places",
    f"""SELECT 'pais' AS nivel, pais_normalizado AS lugar, registros FROM ({top_sql("pais_normalizado", 5)})
 UNION ALL SELECT 'ciudad', ciudad_normalizada, registros FROM ({top_sql("ciudad_normalizada", 5)})""",
)
def _(t):
    countries = wh.top_k(fact(t), "pais_normalizado", 5).select(F.lit("pais").alias("nivel"), F.col("pais_normalizado").alias("lugar"), "registros")
    cities = wh.top_k(fact(t), "ciudad_normalizada", 5).select(F.lit("ciudad").alias("nivel"), F.col("ciudad_normalizada").alias("lugar"), "registros")
    return countries.unionByName(cities)


SALARY = f"""SELECT count(salario_usd) AS registros_con_salario, {r("coalesce(avg(salario_usd), 0)", 4)} AS salario_promedio,
 {r("coalesce(median(salario_usd), 0)", 4)} AS salario_mediano FROM ({UNIFIED})"""


@query("salary_metrics", SALARY)
def _(t):
    return rounded(wh.salary_metrics(fact(t)), 4)


def bands_sql(column: str, bands: B.Bands) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS banda, count(*) FILTER ({column} = '{label}') AS registros FROM ({FACT})" for label in bands.labels
    )


@query("band_distribution", bands_sql("rango_salario", B.SALARY_RANGE))
def _(t):
    return wh.band_distribution(fact(t), "rango_salario", B.SALARY_RANGE)


@query(
    "experience_metrics",
    f"""SELECT count(anos_experiencia) AS registros_con_experiencia, {r("coalesce(avg(anos_experiencia), 0)")} AS experiencia_promedio
 FROM ({UNIFIED})""",
)
def _(t):
    return rounded(wh.experience_metrics(fact(t)))


@query(
    "top_k_tech",
    f"""SELECT 'lenguaje' AS tipo, tecnologia_principal AS nombre, registros FROM ({top_sql("tecnologia_principal", 10)})
 UNION ALL SELECT 'framework', framework_herramienta, registros FROM ({top_sql("framework_herramienta", 10)})""",
)
def _(t):
    languages = wh.top_k(fact(t), "tecnologia_principal", 10).select(F.lit("lenguaje").alias("tipo"), F.col("tecnologia_principal").alias("nombre"), "registros")
    frameworks = wh.top_k(fact(t), "framework_herramienta", 10).select(F.lit("framework").alias("tipo"), F.col("framework_herramienta").alias("nombre"), "registros")
    return languages.unionByName(frameworks)


@query("warehouse_fact", FACT)
def _(t):
    return ntz(fact(t))


def _long(section, metric, key, value, source):
    return f"SELECT '{section}' AS seccion, '{metric}' AS metrica, {key} AS clave, {r(value, 4)} AS valor FROM ({source})"


@query(
    "warehouse_summary",
    " UNION ALL ".join(
        [
            _long("resumen_general", "total_registros", N, "count(*)", UNIFIED),
            _long("resumen_general", "fuentes_datos", "fuente_datos", "n", f"SELECT fuente_datos, count(*) AS n FROM ({UNIFIED}) GROUP BY 1"),
            _long("distribucion_geografica", "paises_unicos", N, "count(DISTINCT pais_normalizado)", FACT),
            _long("distribucion_geografica", "ciudades_unicas", N, "count(DISTINCT ciudad_normalizada)", FACT),
            _long("distribucion_geografica", "top_paises", "pais_normalizado", "registros", top_sql("pais_normalizado", 5)),
            _long("distribucion_geografica", "top_ciudades", "ciudad_normalizada", "registros", top_sql("ciudad_normalizada", 5)),
            _long("metricas_salariales", "registros_con_salario", N, "registros_con_salario", SALARY),
            _long("metricas_salariales", "salario_promedio", N, "salario_promedio", SALARY),
            _long("metricas_salariales", "salario_mediano", N, "salario_mediano", SALARY),
            _long("metricas_salariales", "distribucion_rangos", "banda", "registros", bands_sql("rango_salario", B.SALARY_RANGE)),
            _long("metricas_experiencia", "registros_con_experiencia", N, "count(anos_experiencia)", UNIFIED),
            _long("metricas_experiencia", "experiencia_promedio", N, "avg(anos_experiencia)", UNIFIED),
            _long("metricas_experiencia", "distribucion_niveles", "banda", "registros", bands_sql("nivel_experiencia_grupo", B.EXPERIENCE)),
            _long("tecnologias_populares", "lenguajes", "tecnologia_principal", "registros", top_sql("tecnologia_principal", 10)),
            _long("tecnologias_populares", "frameworks", "framework_herramienta", "registros", top_sql("framework_herramienta", 10)),
        ]
    ),
)
def _(t):
    return rounded(wh.warehouse_summary(fact(t)), 4)
