"""Both runs, end to end, on CSV sources built from the given tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.config import MiningLimits
from millrace.plans import runs
from millrace.queries.base import Tables
from millrace.sources.csv import write_csv

RUN = datetime(2025, 11, 17, 12, 0)
HEADERS = {
    "jobs": {
        "id_oferta": "ID_Oferta", "empresa": "Empresa", "cargo": "Cargo", "ciudad": "Ciudad", "pais": "País",
        "lenguaje": "Lenguaje", "framework": "Framework", "nivel_seniority": "Nivel_Seniority",
        "modalidad": "Modalidad", "salario_anual_usd": "Salario_Anual_USD", "fecha_publicacion": "Fecha_Publicación",
    },
    "investments": {
        "id_programa": "ID_Programa", "organizacion": "Organización", "area_tecnologica": "Área_Tecnológica",
        "inversion_usd": "Inversión_USD", "participantes": "Participantes", "duracion_meses": "Duración_Meses",
        "satisfaccion_promedio": "Satisfacción_Promedio", "ano": "Año", "ciudad": "Ciudad", "pais": "País",
    },
    "profiles": {
        "id_persona": "ID_Persona", "edad": "Edad", "ciudad": "Ciudad", "pais": "País",
        "lenguajes_dominio": "Lenguajes_Dominio", "frameworks_dominio": "Frameworks_Dominio",
        "certificaciones": "Certificaciones", "anos_experiencia": "Años_Experiencia",
        "nivel_educativo": "Nivel_Educativo", "area_trabajo_actual": "Área_Trabajo_Actual",
        "salario_actual_usd": "Salario_Actual_USD",
    },
}


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sources")
    t = Tables(spark, "/root/testdata/sf0.001")
    paths = {}
    for name, headers in HEADERS.items():
        df = getattr(t, name).select(*[F.col(c).alias(h) for c, h in headers.items()])
        if name == "jobs":
            money = F.concat(F.lit("$"), F.format_number("Salario_Anual_USD", 2))
            df = df.withColumn("Salario_Anual_USD", money)
            df = df.withColumn("Fecha_Publicación", F.date_format("Fecha_Publicación", "dd/MM/yyyy"))
        df = df.unionByName(df.where(F.crc32(F.col(df.columns[0])) % 10 == 0))
        paths[name] = str(folder / name)
        write_csv(df, paths[name])
    return runs.three_sources(paths["jobs"], paths["investments"], paths["profiles"])


def test_three_sources(spark, files, tmp_path):
    out = str(tmp_path / "out")
    limits = MiningLimits(kmeans_restarts=1, trees=5)
    metrics = runs.run_three_sources(spark, files, out, RUN, limits=limits).first()

    processed = metrics["registros_procesados"]
    sizes = {n: spark.read.parquet(f"{out}/processed/{n}").count() for n in files}
    assert processed["total_registros"] == sum(sizes.values()) == processed["warehouse_consolidado"]
    removed = metrics["resumen_calidad"]["duplicados_eliminados"]
    assert removed["empleos"] > 0 and removed["perfiles"] > 0
    assert metrics["resultados_validacion"]["perfiles"] == "failed"  # ages from 0 up

    assert processed["fecha_procesamiento"] == RUN.isoformat()
    totals = {(r["seccion"], r["metrica"]): r["valor"] for r in metrics["warehouse_consolidado"] if r["clave"] is None}
    assert totals["resumen_general", "total_registros"] == sum(sizes.values())
    names = metrics["tablas_bi"].split(",")
    assert metrics["exportacion"]["datasets_created"] == len(names) == 6
    assert metrics["exportacion"]["total_records"] == sum(
        spark.read.option("header", True).csv(f"{out}/bi/{n}").count() for n in names
    )

    fact = spark.read.parquet(f"{out}/fact")
    assert len(fact.columns) == 30
    jobs = fact.where("fuente_datos = 'empleos_tech'")
    assert jobs.where("salario_usd IS NOT NULL").count() > 0
    assert jobs.where("fecha_referencia IS NULL OR anio_referencia IS NULL").count() == 0
    people = fact.where("fuente_datos = 'perfiles_habilidades'")
    assert people.where("anos_experiencia IS NOT NULL").count() > 0

    def table(name):
        return spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/bi/{name}")

    geography = table("geography")
    assert geography.agg(F.sum("Total_Registros")).first()[0] == fact.count()
    salaries = fact.where("salario_usd IS NOT NULL").count()
    assert geography.agg(F.sum("Total_Empleos")).first()[0] == salaries
    assert table("clusters").agg(F.sum("Cantidad_Perfiles")).first()[0] == people.count()
    assert {r["Periodo"] for r in table("time_metrics").collect()} == {"Año 2025", "Q4-2025"}
    kpis = {r["KPI"]: r["Valor"] for r in table("kpis").collect()}
    assert kpis["Total Registros"] == fact.count()
    assert kpis["Clusters Identificados"] == table("clusters").count()

    summary = spark.read.parquet(f"{out}/summary")
    banded = summary.where("metrica = 'distribucion_rangos'").agg(F.sum("valor")).first()[0]
    assert banded == fact.where("salario_usd > 0").count()
    reports = spark.read.parquet(f"{out}/validation")
    assert {r[0] for r in reports.select("dataset").distinct().collect()} == {"empleos", "inversiones", "perfiles"}


def test_two_sources(spark, files, tmp_path):
    out = str(tmp_path / "out")
    two = {n: files[n] for n in ("jobs", "investment")}
    metrics = runs.run_two_sources(spark, two, out, RUN).first()
    assert "warehouse_consolidado" not in metrics["registros_procesados"].asDict()
    assert metrics["registros_procesados"]["total_registros"] == sum(
        spark.read.parquet(f"{out}/processed/{n}").count() for n in two
    )
    assert metrics["resumen_calidad"]["estado_general"] in ("EXCELENTE", "BUENO", "REGULAR", "NECESITA_MEJORA")
