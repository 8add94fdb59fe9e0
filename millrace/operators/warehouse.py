"""Unified fact table of several sources, its derived columns and its summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import bands as B
from millrace.functions.text import fold_accents, title_case
from millrace.operators.quantiles import table_quantiles
from millrace.session import settle

# Source tags, the fact's columns in order with their types, and which source
# column fills which fact column.
JOBS, INVESTMENTS, PROFILES = "empleos_tech", "inversiones_tech", "perfiles_habilidades"

FACT_COLUMNS = {
    "fuente_datos": "string",
    "fecha_procesamiento": "timestamp",
    "id_registro": "string",
    "empresa_organizacion": "string",
    "cargo_area": "string",
    "ciudad": "string",
    "pais": "string",
    "tecnologia_principal": "string",
    "framework_herramienta": "string",
    "nivel_experiencia": "string",
    "salario_usd": "double",
    "modalidad_tipo": "string",
    "fecha_referencia": "timestamp",
    "anio_referencia": "int",
    "edad": "double",
    "anos_experiencia": "double",
    "nivel_educativo": "string",
    "certificaciones": "string",
    "inversion_usd": "double",
    "participantes": "double",
    "duracion_meses": "double",
    "satisfaccion_promedio": "double",
}


@dataclass(frozen=True)
class Source:
    """Where a source's columns go; a tuple of names takes the first one that is there."""

    tag: str
    fields: Mapping[str, str | tuple[str, ...]] = field(default_factory=dict)


JOBS_SOURCE = Source(
    JOBS,
    {
        "id_registro": "id_oferta",
        "empresa_organizacion": "empresa",
        "cargo_area": "cargo",
        "tecnologia_principal": "lenguaje",
        "framework_herramienta": "framework",
        "nivel_experiencia": "nivel_seniority",
        "salario_usd": "salario_anual_usd",
        "modalidad_tipo": "modalidad",
        "fecha_referencia": "fecha_publicacion",
        "anio_referencia": "fecha_publicacion_year",
    },
)
INVESTMENTS_SOURCE = Source(
    INVESTMENTS,
    {
        "id_registro": "id_programa",
        "empresa_organizacion": "organizacion",
        "cargo_area": "area_tecnologica",
        "inversion_usd": "inversion_usd",
        "participantes": "participantes",
        "duracion_meses": "duracion_meses",
        "satisfaccion_promedio": "satisfaccion_promedio",
        "anio_referencia": ("ano", "año"),
    },
)
PROFILES_SOURCE = Source(
    PROFILES,
    {
        "id_registro": "id_persona",
        "edad": "edad",
        "tecnologia_principal": "lenguajes_dominio",
        "framework_herramienta": "frameworks_dominio",
        "certificaciones": "certificaciones",
        "anos_experiencia": "anos_experiencia",
        "nivel_educativo": "nivel_educativo",
        "cargo_area": "area_trabajo_actual",
        "salario_usd": "salario_actual_usd",
    },
)
UNSPECIFIED = "No Especificado"


def conform(df: DataFrame, tag: str, run_time: datetime) -> DataFrame:
    """Common columns of a source: ``país`` becomes ``pais``; source tag and run time join."""
    if "país" in df.columns:
        df = df.drop("pais").withColumnRenamed("país", "pais")
    return df.withColumns(
        {"fuente_datos": F.lit(tag), "fecha_procesamiento": F.lit(run_time).cast("timestamp")}
    )


def map_source(df: DataFrame, source: Source, run_time: datetime, accent_fold: bool = True) -> DataFrame:
    """A source in the columns of the fact, absent ones null.

    With ``accent_fold`` the lookup ignores accents, so ``años_experiencia`` is found under
    ``anos_experiencia``. Without it accented columns stay empty, as the plain names miss them.
    """
    df = conform(df, source.tag, run_time)
    available = {c: c for c in df.columns}
    if accent_fold:
        available = {fold_accents(c): c for c in df.columns} | available
    common = {c: c for c in ("fuente_datos", "fecha_procesamiento", "ciudad", "pais")}
    wanted = common | dict(source.fields)
    columns = []
    for name, kind in FACT_COLUMNS.items():
        names = wanted.get(name, ())
        names = (names,) if isinstance(names, str) else names
        found = next((available[n] for n in names if n in available), None)
        value = F.lit(None) if found is None else F.col(f"`{found}`")
        columns.append(value.cast(kind).alias(name))
    return df.select(*columns)


def unify(
    sources: Sequence[tuple[DataFrame, Source]], run_time: datetime, accent_fold: bool = True
) -> DataFrame:
    """All sources below each other in the fact's 22 columns."""
    mapped = [map_source(df, source, run_time, accent_fold) for df, source in sources]
    fact = mapped[0]
    for part in mapped[1:]:
        fact = fact.unionByName(part)
    return fact


def add_derived(fact: DataFrame) -> DataFrame:
    """Presence flags, bands, place names and the parts of the run time."""
    salary, years = F.col("salario_usd"), F.col("anos_experiencia")
    return fact.withColumns(
        {
            "tiene_salario": salary.isNotNull(),
            "rango_salario": B.band(salary, B.SALARY_RANGE),
            "tiene_experiencia": years.isNotNull(),
            "nivel_experiencia_grupo": B.band(years, B.EXPERIENCE),
            "pais_normalizado": F.coalesce(title_case(F.col("pais")), F.lit(UNSPECIFIED)),
            "ciudad_normalizada": F.coalesce(title_case(F.col("ciudad")), F.lit(UNSPECIFIED)),
            "mes_procesamiento": F.month("fecha_procesamiento"),
            "ano_procesamiento": F.year("fecha_procesamiento"),
        }
    )


def build_fact(
    jobs: DataFrame, investments: DataFrame, profiles: DataFrame, run_time: datetime, accent_fold: bool = True
) -> DataFrame:
    sources = [(jobs, JOBS_SOURCE), (investments, INVESTMENTS_SOURCE), (profiles, PROFILES_SOURCE)]
    return add_derived(unify(sources, run_time, accent_fold))


# -- summary ------------------------------------------------------------------------------


def counts_by(df: DataFrame, column: str, out: str = "registros") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(out))


def top_k(df: DataFrame, column: str, k: int, out: str = "registros") -> DataFrame:
    """Most frequent non-null values, equals in value order."""
    counts = counts_by(df.where(F.col(column).isNotNull()), column, out)
    return counts.orderBy(F.desc(out), F.asc(column)).limit(k)


def distinct_places(fact: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of countries and cities, exact by default.

    Distinct pairs come first: both counts then read a table of places, not the fact.
    """
    if approximate:
        count = F.approx_count_distinct
        return fact.agg(count("pais_normalizado").alias("paises"), count("ciudad_normalizada").alias("ciudades"))
    places = fact.select("pais_normalizado", "ciudad_normalizada").distinct()
    return places.agg(
        F.count_distinct("pais_normalizado").alias("paises"), F.count_distinct("ciudad_normalizada").alias("ciudades")
    )


def salary_metrics(fact: DataFrame) -> DataFrame:
    """Number of salaries, mean and median; 0 when there are none."""
    middle = table_quantiles(fact, ["salario_usd"], [0.5])["salario_usd"][0]
    totals = fact.agg(
        F.count("salario_usd").alias("registros_con_salario"),
        F.coalesce(F.avg("salario_usd"), F.lit(0.0)).alias("salario_promedio"),
    )
    return totals.withColumn("salario_mediano", F.coalesce(middle, F.lit(0.0)))


def experience_metrics(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count("anos_experiencia").alias("registros_con_experiencia"),
        F.coalesce(F.avg("anos_experiencia"), F.lit(0.0)).alias("experiencia_promedio"),
    )


def band_distribution(df: DataFrame, column: str, bands: B.Bands) -> DataFrame:
    """Rows per band, empty bands included, from one aggregate."""
    entries = [
        F.struct(F.lit(label).alias("banda"), F.count_if(F.col(column) == label).alias("registros"))
        for label in bands.labels
    ]
    return df.agg(F.array(*entries).alias("r")).select(F.inline("r"))


def fact_counts(fact: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column and over all, from one scan: ``columna, clave, registros`` and the totals.

    The row without a column holds the totals; those of the others are not asked for. A table of one row
    per value is worked out once and read by all that need a part of it.
    """
    sets = [[c] for c in columns] + [[]]
    grouped = fact.select(*columns, "salario_usd", "anos_experiencia").groupingSets(sets, *columns).agg(
        F.grouping_id().alias("__set"),
        F.count(F.lit(1)).alias("registros"),
        F.count("salario_usd").alias("salarios"),
        F.avg("salario_usd").alias("salario_promedio"),
        F.max("salario_usd").alias("salario_maximo"),
        F.count("anos_experiencia").alias("experiencias"),
        F.avg("anos_experiencia").alias("experiencia_promedio"),
    )
    everything = 2 ** len(columns) - 1
    names = [F.when(F.col("__set") == everything - 2 ** (len(columns) - 1 - i), F.lit(c)) for i, c in enumerate(columns)]
    key = F.coalesce(*[F.col(c).cast("string") for c in columns])
    return settle(grouped.select(F.coalesce(*names).alias("columna"), key.alias("clave"), *grouped.columns[len(columns) + 1 :]))


def counts_of(counts: DataFrame, column: str) -> DataFrame:
    return counts.where(F.col("columna") == column)


def warehouse_summary(fact: DataFrame) -> DataFrame:
    """The whole summary as long rows ``seccion, metrica, clave, valor``: one scan for counts and means, two for the median."""
    counts = fact_counts(
        fact,
        [
            "fuente_datos", "pais_normalizado", "ciudad_normalizada", "rango_salario", "nivel_experiencia_grupo",
            "tecnologia_principal", "framework_herramienta",
        ],
    )

    def rows(df: DataFrame, section: str, metric: str) -> DataFrame:
        value = F.col("registros").cast("double").alias("valor")
        return df.select(F.lit(section).alias("seccion"), F.lit(metric).alias("metrica"), "clave", value)

    def per_value(column: str) -> DataFrame:
        return counts_of(counts, column)

    def top(column: str, k: int) -> DataFrame:
        return per_value(column).where("clave is not null").orderBy(F.desc("registros"), F.asc("clave")).limit(k)

    def per_band(column: str, bands: B.Bands) -> DataFrame:
        entries = [
            F.struct(
                F.lit(label).alias("clave"),
                F.coalesce(F.sum(F.when(F.col("clave") == label, F.col("registros"))), F.lit(0)).alias("registros"),
            )
            for label in bands.labels
        ]
        return per_value(column).agg(F.array(*entries).alias("r")).select(F.inline("r"))

    def known(column: str) -> Column:
        return F.count_if((F.col("columna") == column) & F.col("clave").isNotNull())

    def total(column: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("columna").isNull(), F.col(column))), F.lit(0))

    middle = table_quantiles(fact, ["salario_usd"], [0.5])["salario_usd"][0]
    figures = [
        ("resumen_general", "total_registros", total("registros")),
        ("distribucion_geografica", "paises_unicos", known("pais_normalizado")),
        ("distribucion_geografica", "ciudades_unicas", known("ciudad_normalizada")),
        ("metricas_salariales", "registros_con_salario", total("salarios")),
        ("metricas_salariales", "salario_promedio", total("salario_promedio")),
        ("metricas_salariales", "salario_mediano", F.coalesce(middle, F.lit(0.0))),
        ("metricas_experiencia", "registros_con_experiencia", total("experiencias")),
        ("metricas_experiencia", "experiencia_promedio", total("experiencia_promedio")),
    ]
    entries = [
        F.struct(
            F.lit(section).alias("seccion"), F.lit(metric).alias("metrica"),
            F.lit(None).cast("string").alias("clave"), value.cast("double").alias("valor"),
        )
        for section, metric, value in figures
    ]
    parts = [
        counts.agg(F.array(*entries).alias("r")).select(F.inline("r")),
        rows(per_value("fuente_datos"), "resumen_general", "fuentes_datos"),
        rows(top("pais_normalizado", 5), "distribucion_geografica", "top_paises"),
        rows(top("ciudad_normalizada", 5), "distribucion_geografica", "top_ciudades"),
        rows(per_band("rango_salario", B.SALARY_RANGE), "metricas_salariales", "distribucion_rangos"),
        rows(per_band("nivel_experiencia_grupo", B.EXPERIENCE), "metricas_experiencia", "distribucion_niveles"),
        rows(top("tecnologia_principal", 10), "tecnologias_populares", "lenguajes"),
        rows(top("framework_herramienta", 10), "tecnologias_populares", "frameworks"),
    ]
    return reduce(DataFrame.unionByName, parts)
