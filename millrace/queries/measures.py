"""Dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import marts, measures, mining
from millrace.queries.base import query, r, rounded
from millrace.queries.marts import CLUSTER_SQL, GEO_RANKED, TECH, WITH_ASSIGNED, assigned
from millrace.queries.warehouse import FACT, fact, stored_fact


@query(
    "star_join",
    f"""SELECT f.id_registro, f.pais_normalizado, f.tecnologia_principal, g."Region", g."Ranking_Salario", g."Salario_Promedio" AS "Salario_Pais",
 k."Popularidad_Rank", k."Total_Menciones" FROM ({FACT}) f LEFT JOIN ({GEO_RANKED}) g ON f.pais_normalizado = g.pais_normalizado
 LEFT JOIN (SELECT * FROM ({TECH}) WHERE "Tipo" = 'Lenguaje' AND "Popularidad_Rank" <= 15) k ON f.tecnologia_principal = k."Tecnologia" """,
)
def _(t):
    stored = stored_fact(t)
    rows = stored.select("id_registro", "pais_normalizado", "tecnologia_principal")
    return rounded(measures.star_join(rows, marts.geography_ranking(stored), marts.top_technologies(stored)), 2)


@query(
    "cluster_join",
    f"""{WITH_ASSIGNED} SELECT a.id_registro, a.cluster AS cluster_asignado, c."Cluster_Nombre", c."Categoria_Cluster", c."Salario_Promedio"
 FROM profiles_assigned a LEFT JOIN ({CLUSTER_SQL}) c ON a.cluster = c."Cluster_ID" """,
)
def _(t):
    people = assigned(t).select("id_registro", F.col("cluster").alias("cluster_asignado"))
    clusters = marts.cluster_table(mining.cluster_profile(assigned(t)))
    joined = measures.cluster_join(people, clusters)
    return rounded(joined.select("id_registro", "cluster_asignado", "Cluster_Nombre", "Categoria_Cluster", "Salario_Promedio"), 2)


@query(
    "measures_basic",
    f"SELECT count(id_registro) AS total_profesionales, {r('avg(salario_usd)', 4)} AS salario_promedio FROM ({FACT})",
)
def _(t):
    return rounded(measures.basic_measures(fact(t)), 4)


@query(
    "salary_gap",
    f"""SELECT pais_normalizado, {r("max(salario_usd) - min(salario_usd)")} AS brecha_salarial FROM ({FACT}) GROUP BY pais_normalizado
 UNION ALL SELECT NULL, {r("max(salario_usd) - min(salario_usd)")} FROM ({FACT})""",
)
def _(t):
    by_country = measures.salary_gap(fact(t), ["pais_normalizado"])
    overall = measures.salary_gap(fact(t)).withColumn("pais_normalizado", F.lit(None).cast("string"))
    return rounded(by_country.unionByName(overall))


@query("top_one", f"""SELECT * FROM ({GEO_RANKED}) ORDER BY "Salario_Promedio" DESC NULLS LAST, pais_normalizado LIMIT 1""")
def _(t):
    return rounded(measures.top_country(marts.geography_table(fact(t))), 2)


# A third of the events moved to February and April: March is missing, so April has no growth.
SPREAD = """SELECT event_id, event_type, value, CAST(CASE WHEN event_id % 9 = 0 THEN TIMESTAMP '2024-04-10 00:00:00'
 WHEN event_id % 9 < 3 THEN TIMESTAMP '2024-02-03 05:00:00' ELSE ts END AS TIMESTAMP) AS seen FROM {events}"""


@query(
    "mom_growth",
    f"""WITH m AS (SELECT CAST(date_trunc('month', seen) AS DATE) AS mes, count(*) AS registros FROM ({SPREAD}) GROUP BY 1)
 SELECT a.mes, a.registros, {r("(a.registros - b.registros) / CAST(b.registros AS DOUBLE)")} AS tasa_crecimiento
 FROM m a LEFT JOIN m b ON b.mes = CAST(a.mes - INTERVAL 1 MONTH AS DATE)""",
)
def _(t):
    return rounded(measures.monthly_growth(t.sql(SPREAD), "seen", "event_id"))


@query(
    "source_share",
    f"""SELECT fuente_datos, count(*) AS registros, {r(f"count(*) * 100.0::DOUBLE / (SELECT count(*) FROM ({FACT}))")} AS porcentaje
 FROM ({FACT}) GROUP BY fuente_datos""",
)
def _(t):
    return rounded(measures.source_share(fact(t)))


@query(
    "monthly_by_source",
    f"""SELECT CAST(date_trunc('month', seen) AS DATE) AS "Fecha", event_type AS "Fuente_Datos", count(*) AS "Registros_Mes",
 {r("avg(value)")} AS "Salario_Promedio_Mes" FROM ({SPREAD}) GROUP BY 1, 2""",
)
def _(t):
    return rounded(measures.monthly_by_source(t.sql(SPREAD), "seen", "event_type", "value"))


@query(
    "fact_filter",
    f"""SELECT id_registro, pais_normalizado, fuente_datos, rango_salario, salario_usd FROM ({FACT})
 WHERE pais_normalizado IN ('Usa', 'Chile', 'Perú') AND fuente_datos = 'empleos_tech' AND rango_salario IN ('<50K', '75K-100K')
 AND salario_usd BETWEEN 1000 AND 90000 AND year(fecha_referencia) = 1998 AND month(fecha_referencia) = 3""",
)
def _(t):
    rows = measures.filter_fact(
        fact(t), ["Usa", "Chile", "Perú"], ["empleos_tech"], ["<50K", "75K-100K"], (1000, 90000), 1998, 3
    )
    return rows.select("id_registro", "pais_normalizado", "fuente_datos", "rango_salario", "salario_usd")


@query(
    "drill_rollup",
    f"""SELECT pais_normalizado, ciudad_normalizada, CAST(2 - grouping(pais_normalizado) - grouping(ciudad_normalizada) AS INT) AS nivel,
 count(id_registro) AS registros, {r("avg(salario_usd)", 4)} AS salario_promedio FROM ({FACT}) GROUP BY ROLLUP (pais_normalizado, ciudad_normalizada)""",
)
def _(t):
    return rounded(measures.drill_rollup(fact(t)), 4)


@query(
    "drill_individuals",
    f"""SELECT id_registro, salario_usd FROM ({FACT}) WHERE pais_normalizado = 'Usa' AND ciudad_normalizada = 'Villa O''9Nova'""",
)
def _(t):
    return measures.individuals(fact(t), "Usa", "Villa O'9Nova").select("id_registro", "salario_usd")


@query(
    "top_ten_countries",
    f"""SELECT * FROM ({GEO_RANKED}) ORDER BY "Total_Registros" DESC, pais_normalizado LIMIT 10""",
)
def _(t):
    return rounded(measures.top_countries(marts.geography_table(fact(t))), 2)
