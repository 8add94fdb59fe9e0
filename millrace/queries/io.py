"""Source and sink queries. They write to a folder of their own below the shared one."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import clean, validate
from millrace.operators import warehouse as wh
from millrace.plans import runs
from millrace.queries.base import query, r, rounded
from millrace.queries.warehouse import FACT, fact
from millrace.session import scratch_path
from millrace.sources import csv, sinks

# Orders with gaps written as tokens, quotes, commas and outer blanks.
NOTED = """SELECT *, CASE o_orderkey % 6 WHEN 0 THEN 'N/A' WHEN 1 THEN 'null' WHEN 2 THEN 'says "yes", maybe'
 WHEN 3 THEN '  padded ' WHEN 4 THEN NULL ELSE o_orderpriority END AS note,
 CASE WHEN o_orderkey % 7 = 0 THEN 'NaN' ELSE CAST(o_custkey AS STRING) END AS amount FROM {orders}"""
READ_BACK = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate, o_orderpriority,
 CASE o_orderkey % 6 WHEN 2 THEN 'says "yes", maybe' WHEN 3 THEN '  padded ' WHEN 5 THEN o_orderpriority END AS note,
 CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS amount FROM orders"""
CSV_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
        T.StructField("note", T.StringType()),
        T.StructField("amount", T.LongType()),
    ]
)


def _csv(t, name):
    path = scratch_path(t.spark, name)
    csv.write_csv(t.sql(NOTED), path)
    return path


@query("scan_csv", READ_BACK)
def _(t):
    return csv.scan_csv(t.spark, _csv(t, "orders-csv"), CSV_SCHEMA)


@query("scan_csv_inferred", READ_BACK)
def _(t):
    read = csv.scan_csv(t.spark, _csv(t, "orders-csv"))
    return read.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


# Notes of two lines and more, with quotes and commas beside the breaks.
BROKEN = """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN concat('first', chr(10), 'second, "', o_orderpriority, '"')
 WHEN 1 THEN concat(chr(10), o_orderpriority, chr(10), chr(10), 'end') WHEN 2 THEN 'one "line"' ELSE o_orderpriority END AS note, o_totalprice FROM {orders}"""


@query("scan_csv_line_breaks", BROKEN)
def _(t):
    path = scratch_path(t.spark, "broken-csv")
    csv.write_csv(t.sql(BROKEN).repartition(3), path)
    return csv.scan_csv(t.spark, path, T.StructType([CSV_SCHEMA[c] for c in ("o_orderkey", "note", "o_totalprice")]))


@query(
    "tag_source_union",
    """SELECT id_oferta AS id, 'jobs' AS source FROM {jobs} UNION ALL SELECT id_programa, 'investment' FROM {investments}
 UNION ALL SELECT id_persona, 'profiles' FROM {profiles}""",
)
def _(t):
    jobs = csv.tag_source(t.jobs.select(F.col("id_oferta").alias("id")), "jobs")
    programmes = csv.tag_source(t.investments.select(F.col("id_programa").alias("id")), "investment")
    people = csv.tag_source(t.profiles.select(F.col("id_persona").alias("id")), "profiles")
    return jobs.unionByName(programmes).unionByName(people)


@query(
    "fact_partitioned",
    f"SELECT id_registro, salario_usd, pais_normalizado, fuente_datos FROM ({FACT}) WHERE fuente_datos = 'perfiles_habilidades'",
)
def _(t):
    path = scratch_path(t.spark, "fact")
    sinks.write_table(fact(t), path, partition_by="fuente_datos")
    kept = t.spark.read.parquet(path).where(F.col("fuente_datos") == wh.PROFILES)
    return kept.select("id_registro", "salario_usd", "pais_normalizado", "fuente_datos")


@query(
    "tables_written",
    "SELECT 'jobs' AS tabla, count(*) AS filas FROM orders UNION ALL SELECT 'people', count(*) FROM customer",
)
def _(t):
    path = scratch_path(t.spark, "tables")
    tables = {"jobs": t.jobs, "people": t.profiles, "none": t.jobs.where("job_key < 0"), "absent": None}
    rows = None
    for name in sinks.write_tables(tables, path):
        one = t.spark.read.parquet(f"{path}/{name}").agg(F.count(F.lit(1)).alias("filas"))
        one = one.select(F.lit(name).alias("tabla"), "filas")
        rows = one if rows is None else rows.unionByName(one)
    return rows


RUN = datetime(2024, 11, 16, 10, 30)


FILLED = {
    "empleos": ("jobs", ("id_oferta", "ciudad", "pais", "lenguaje", "nivel_seniority", "salario_anual_usd")),
    "perfiles": ("profiles", ("id_persona", "edad", "ciudad", "pais", "lenguajes_dominio", "salario_actual_usd")),
}


@query(
    "report_appended",
    " UNION ALL ".join(
        f"""SELECT '{dataset}' AS dataset, '{c}' AS "column", CAST(count({c}) AS DOUBLE) AS filled,
 {r(f"count({c}) * 100.0 / count(*)", 2)} AS pct FROM {{{table}}}"""
        for dataset, (table, columns) in FILLED.items()
        for c in columns
    ),
)
def _(t):
    path = scratch_path(t.spark, "report")
    for name, (table, columns) in FILLED.items():
        sinks.append_report(validate.validation_report(getattr(t, table).select(*columns), {}, name, as_of=RUN), path)
    both = t.spark.read.parquet(path).where("part = 'completeness' AND column IS NOT NULL")
    return rounded(both.select("dataset", "column", F.col("value").alias("filled"), "pct"), 2)


@query(
    "run_metrics",
    f"""WITH c AS (SELECT count(*) AS n FROM {{copied}}), o AS (SELECT count(*) AS n FROM orders), p AS (SELECT count(*) AS n,
 (count(edad) + count(salario_actual_usd)) * 50.0 / count(*) AS filled FROM {{profiles}})
 SELECT '2024-11-16T10:30:00' AS fecha_ejecucion, o.n AS empleos, p.n AS perfiles, o.n + p.n AS total_registros,
 '2024-11-16T10:30:00' AS fecha_procesamiento, CAST(2 AS BIGINT) AS datasets_created, o.n + p.n AS total_records,
 {r("(100 + round_even(filled * 100.0, 0) / 100.0) / 2", 2)} AS puntuacion, 'passed' AS estado_empleos,
 CASE WHEN (100 + filled) / 2 > 90 THEN 'EXCELENTE' ELSE 'BUENO' END AS estado_general,
 c.n - o.n AS duplicados_empleos, CAST(0 AS BIGINT) AS duplicados_perfiles FROM c, o, p""",
)
def _(t):
    jobs, n_jobs, _ = clean.deduplicate_counted(t.copied)
    people, n_people, _ = clean.deduplicate_counted(t.profiles.select("edad", "salario_actual_usd", "id_persona"))
    folder, reported = scratch_path(t.spark, "exported"), scratch_path(t.spark, "reports")
    exported = sinks.write_tables({"jobs": jobs, "profiles": people}, folder)
    loaded = {name: t.spark.read.parquet(f"{folder}/{name}") for name in exported}
    for name, table in (("empleos", loaded["jobs"]), ("perfiles", loaded["profiles"].drop("id_persona"))):
        sinks.append_report(validate.validation_report(table, {}, name, as_of=RUN), reported)
    metrics = runs.run_metrics({"jobs": n_jobs, "profiles": n_people}, exported, t.spark.read.parquet(reported), RUN, exported=exported)
    path = scratch_path(t.spark, "metrics")
    sinks.write_json_document(metrics, path)
    read = t.spark.read.schema(metrics.schema).json(path)
    return rounded(
        read.select(
            "fecha_ejecucion",
            "registros_procesados.empleos",
            "registros_procesados.perfiles",
            "registros_procesados.total_registros",
            "registros_procesados.fecha_procesamiento",
            "exportacion.datasets_created",
            "exportacion.total_records",
            F.col("registros_procesados.puntuacion_calidad_datos").alias("puntuacion"),
            F.col("resultados_validacion.empleos").alias("estado_empleos"),
            "resumen_calidad.estado_general",
            F.col("resumen_calidad.duplicados_eliminados.empleos").alias("duplicados_empleos"),
            F.col("resumen_calidad.duplicados_eliminados.perfiles").alias("duplicados_perfiles"),
        ),
        2,
    )
