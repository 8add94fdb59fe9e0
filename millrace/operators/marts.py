"""BI tables: main data, KPIs, clusters, geography, technology and periods."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import bands as B
from millrace.functions.numbers import round_half_even
from millrace.operators.lookup import fits_broadcast, join_lookup
from millrace.operators.quantiles import group_medians, table_quantiles
from millrace.operators.slices import rank_within
from millrace.operators.warehouse import counts_of, fact_counts
from millrace.session import settle

# Country to region, cluster bands by mean salary, KPI names with category and
# format, and the text for a value outside all bands.
REGIONS = {
    "Usa": "Norte América",
    "España": "Europa",
    "Colombia": "Sur América",
    "Argentina": "Sur América",
    "Chile": "Sur América",
    "Perú": "Sur América",
    "México": "Norte América",
}
OTHER_REGION = "Otro"
CLUSTER_BANDS = ((80_000, "Premium"), (50_000, "Alto"), (25_000, "Medio"))
LOWEST_CLUSTER_BAND = "Emergente"
OUTSIDE = "nan"
DEFAULT_AGE = 30
TOP_TECHNOLOGIES = 15


def main_table(fact: DataFrame, year: int, month: int) -> DataFrame:
    """The fact with salary and age category; a missing salary counts as 0, a missing age as 30."""
    salary = F.coalesce(F.col("salario_usd"), F.lit(0.0))
    age = F.coalesce(F.col("edad"), F.lit(float(DEFAULT_AGE)))
    return fact.withColumns(
        {
            "categoria_salario": F.coalesce(B.band(salary, B.BI_SALARY, True), F.lit(OUTSIDE)),
            "grupo_edad": F.coalesce(B.band(age, B.BI_AGE, True), F.lit(OUTSIDE)),
            "anio": F.lit(year),
            "mes": F.lit(month),
        }
    )


def kpi_table(fact: DataFrame, model_kpis: Mapping[str, float] | None = None) -> DataFrame:
    """Key figures as rows ``KPI, Valor, Categoria, Formato``.

    ``model_kpis`` may give ``clusters`` and ``accuracy`` of the mining run. Salary figures
    are left out when no salary is known.
    """
    counts = fact_counts(fact, ["fuente_datos", "pais_normalizado", "ciudad_normalizada"])

    def known(column: str) -> Column:
        return F.count_if((F.col("columna") == column) & F.col("clave").isNotNull())

    def total(column: str) -> Column:
        return F.max(F.when(F.col("columna").isNull(), F.col(column)))

    middle = table_quantiles(fact, ["salario_usd"], [0.5])["salario_usd"][0]
    totals = counts.agg(
        F.coalesce(total("registros"), F.lit(0)).alias("rows"),
        total("salario_promedio").alias("mean"),
        total("salario_maximo").alias("top"),
        F.struct(known("pais_normalizado").alias("countries"), known("ciudad_normalizada").alias("cities")).alias("places"),
    ).withColumn("median", middle)

    def entry(name: str, value: Column, category: str, form: str) -> Column:
        return F.struct(
            F.lit(name).alias("KPI"), value.cast("double").alias("Valor"),
            F.lit(category).alias("Categoria"), F.lit(form).alias("Formato"),
        )

    entries = [
        entry("Total Registros", F.col("rows"), "Volumen", "Entero"),
        entry("Países Únicos", F.col("places")["countries"], "Geografía", "Entero"),
        entry("Ciudades Únicas", F.col("places")["cities"], "Geografía", "Entero"),
        entry("Salario Promedio", F.col("mean"), "Compensación", "Moneda"),
        entry("Salario Mediano", F.col("median"), "Compensación", "Moneda"),
        entry("Salario Máximo", F.col("top"), "Compensación", "Moneda"),
    ]
    models = dict(model_kpis or {})
    if "clusters" in models:
        entries.append(entry("Clusters Identificados", F.lit(models["clusters"]), "Análisis ML", "Entero"))
    if "accuracy" in models:
        entries.append(entry("Precisión Modelo ML", F.lit(models["accuracy"]), "Análisis ML", "Porcentaje"))
    figures = totals.select(F.inline(F.array(*entries))).where(F.col("Valor").isNotNull())
    sources = counts_of(counts, "fuente_datos").select(
        F.concat(F.lit("Registros "), "clave").alias("KPI"),
        F.col("registros").cast("double").alias("Valor"),
        F.lit("Fuentes").alias("Categoria"),
        F.lit("Entero").alias("Formato"),
    )
    return figures.unionByName(sources)


def cluster_band(salary: Column) -> Column:
    """Band of a mean salary; a missing one is the lowest band."""
    chain = F
    for limit, name in CLUSTER_BANDS:
        chain = chain.when(salary >= limit, F.lit(name))
    return chain.otherwise(F.lit(LOWEST_CLUSTER_BAND))


def cluster_table(profile: DataFrame) -> DataFrame:
    """BI form of a cluster profile (``cluster`` from 1, size, share, means, country)."""
    return profile.select(
        F.col("cluster").alias("Cluster_ID"),
        F.concat(F.lit("Cluster_"), F.col("cluster").cast("string")).alias("Cluster_Nombre"),
        F.col("edad_promedio").alias("Edad_Promedio"),
        F.col("salario_promedio").alias("Salario_Promedio"),
        F.coalesce("pais_predominante", F.lit("Unknown")).alias("Pais_Predominante"),
        F.col("cantidad_perfiles").alias("Cantidad_Perfiles"),
        F.col("porcentaje").alias("Porcentaje_Total"),
        cluster_band(F.col("salario_promedio")).alias("Categoria_Cluster"),
    )


# -- geography ----------------------------------------------------------------------------


def geography_totals(fact: DataFrame) -> DataFrame:
    """Counts and means per country, one aggregate. ``Total_Empleos`` counts the known salaries."""
    return fact.groupBy("pais_normalizado").agg(
        F.count("salario_usd").alias("Total_Empleos"),
        round_half_even(F.avg("salario_usd"), 2).alias("Salario_Promedio"),
        round_half_even(F.avg("edad"), 2).alias("Edad_Promedio"),
        F.count("id_registro").alias("Total_Registros"),
    )


def geography_aggregate(fact: DataFrame) -> DataFrame:
    """Salary and age figures per country."""
    keys, totals = ["pais_normalizado"], geography_totals(fact)
    medians = group_medians(fact, "salario_usd", keys, "__median")
    return join_lookup(totals, medians, keys, null_safe=True, broadcast=False).select(
        *keys,
        "Total_Empleos",
        "Salario_Promedio",
        round_half_even(F.col("__median"), 2).alias("Salario_Mediano"),
        "Edad_Promedio",
        "Total_Registros",
    )


def add_region(df: DataFrame, country: str = "pais_normalizado") -> DataFrame:
    """Region of a country. The lookup has seven entries, so it is an expression, not a join."""
    known = F.coalesce(*[F.when(F.col(country) == c, F.lit(region)) for c, region in REGIONS.items()])
    return df.withColumn("Region", F.coalesce(known, F.lit(OTHER_REGION)))


def add_salary_rank(df: DataFrame) -> DataFrame:
    """Dense rank by mean salary, highest first; countries without one come last."""
    mean = F.col("Salario_Promedio")
    means = settle(df)
    return rank_within(
        means, [mean.isNull(), -mean], "Ranking_Salario", dense=True, small=fits_broadcast(means)
    )


def geography_table(fact: DataFrame) -> DataFrame:
    return add_salary_rank(add_region(geography_aggregate(fact)))


def geography_ranking(fact: DataFrame) -> DataFrame:
    """The table of countries without medians, for those who read ranks and means only."""
    return add_salary_rank(add_region(geography_totals(fact)))


# -- technology ---------------------------------------------------------------------------


def technology_mentions(fact: DataFrame) -> DataFrame:
    """One row per record and named technology; unknown and combined names are left out."""
    entries = F.array(
        F.struct(F.lit("Lenguaje").alias("Tipo"), F.col("tecnologia_principal").alias("Tecnologia")),
        F.struct(F.lit("Framework").alias("Tipo"), F.col("framework_herramienta").alias("Tecnologia")),
    )
    named = fact.select(F.inline(entries), "salario_usd")
    c = F.col("Tecnologia")
    return named.where(c.isNotNull() & (c != "Unknown") & ~c.contains("|"))


def technology_popularity(fact: DataFrame) -> DataFrame:
    """Mentions, mean and median salary (0 if none is known) and rank, per type and name."""
    keys = ["Tipo", "Tecnologia"]
    mentions = technology_mentions(fact)
    totals = mentions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("Total_Menciones"),
        F.coalesce(F.avg("salario_usd"), F.lit(0.0)).alias("Salario_Promedio"),
    )
    medians = group_medians(mentions, "salario_usd", keys, "__median")
    full = join_lookup(totals, medians, keys, broadcast=False).select(
        "Tecnologia", "Tipo", "Total_Menciones", "Salario_Promedio",
        F.coalesce("__median", F.lit(0.0)).alias("Salario_Mediano"),
    )
    counted = settle(full)
    order = [-F.col("Total_Menciones"), F.col("Tecnologia")]
    return rank_within(counted, order, "Popularidad_Rank", ["Tipo"], small=fits_broadcast(counted))


def top_per_group(df: DataFrame, group: str, by: str, tie: str, k: int) -> DataFrame:
    """The k highest rows of each group. Spark cuts each task's rows to k before the shuffle."""
    window = Window.partitionBy(group).orderBy(F.desc(by), F.asc(tie))
    return df.withColumn("__row", F.row_number().over(window)).where(F.col("__row") <= k).drop("__row")


def top_technologies(fact: DataFrame, k: int = TOP_TECHNOLOGIES) -> DataFrame:
    """The most mentioned technologies of each type with rank, mentions and mean salary; at most k names a type."""
    counts = technology_mentions(fact).groupBy("Tipo", "Tecnologia").agg(
        F.count(F.lit(1)).alias("Total_Menciones"),
        F.coalesce(F.avg("salario_usd"), F.lit(0.0)).alias("Salario_Promedio"),
    )
    window = Window.partitionBy("Tipo").orderBy(F.desc("Total_Menciones"), F.asc("Tecnologia"))
    ranked = counts.withColumn("Popularidad_Rank", F.row_number().over(window).cast("long"))
    return settle(ranked.where(F.col("Popularidad_Rank") <= k))


def technology_table(fact: DataFrame, k: int = TOP_TECHNOLOGIES) -> DataFrame:
    """The most mentioned technologies of each type.

    The names are counted and cut to the top first; salaries are then read for those only.
    """
    keys, top = ["Tipo", "Tecnologia"], top_technologies(fact, k)
    # At most k names per type: bounded by k, not by the data.
    kept = technology_mentions(fact).join(F.broadcast(top.select(*keys)), keys, "left_semi")
    medians = group_medians(kept, "salario_usd", keys, "__median")
    return join_lookup(top, medians, keys, broadcast=False).select(
        "Tecnologia", "Tipo", "Total_Menciones", "Salario_Promedio",
        F.coalesce("__median", F.lit(0.0)).alias("Salario_Mediano"),
        "Popularidad_Rank",
    )


# -- periods ------------------------------------------------------------------------------

PERIOD_COLUMNS = (
    "Periodo", "Tipo_Periodo", "Total_Empleos", "Salario_Promedio", "Salario_Mediano", "Edad_Promedia", "Registros_Unicos",
)


def _period_counts(fact: DataFrame, date: str, sets: Sequence[Sequence[str]]) -> DataFrame:
    """Counts, means and distinct ids of the periods of all grouping sets, from one pass over the fact.

    The dated rows are dealt round first: a task holds the distinct ids of its rows for each grouping set, whatever the files of the
    fact hold. They are not dealt by id, as a frequent one would go to one task.
    """
    dated = fact.where(F.col(date).isNotNull()).select(
        F.year(date).alias("__year"), F.quarter(date).alias("__quarter"), "salario_usd", "edad", "id_registro"
    )
    tasks = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dated.repartition(tasks).groupingSets([list(s) for s in sets], "__year", "__quarter").agg(
        F.grouping("__quarter").alias("__whole"),
        F.count("salario_usd").alias("Total_Empleos"),
        round_half_even(F.avg("salario_usd"), 2).alias("Salario_Promedio"),
        round_half_even(F.avg("edad"), 2).alias("__age"),
        F.count_distinct("id_registro").alias("Registros_Unicos"),
    )


def _named_periods(counts: DataFrame, medians: DataFrame | None) -> DataFrame:
    """Years with their median and age; neither is worked out per quarter, both are 0 there."""
    if medians is None:
        full = counts.withColumn("__median", F.lit(0.0))
    else:
        full = join_lookup(counts, medians, ["__year"], broadcast=False)
    whole = F.col("__whole") == 1
    year = F.col("__year").cast("string")
    return full.select(
        F.when(whole, F.concat(F.lit("Año "), year)).otherwise(F.concat(F.lit("Q"), F.col("__quarter").cast("string"), F.lit("-"), year)).alias("Periodo"),
        F.when(whole, F.lit("Anual")).otherwise(F.lit("Trimestral")).alias("Tipo_Periodo"),
        "Total_Empleos",
        "Salario_Promedio",
        F.when(whole, round_half_even(F.col("__median"), 2)).otherwise(F.lit(0.0)).alias("Salario_Mediano"),
        F.when(whole, F.col("__age")).otherwise(F.lit(0.0)).alias("Edad_Promedia"),
        "Registros_Unicos",
    ).select(*PERIOD_COLUMNS)


def _year_medians(fact: DataFrame, date: str) -> DataFrame:
    return group_medians(fact.where(F.col(date).isNotNull()).withColumn("__year", F.year(date)), "salario_usd", ["__year"], "__median")


def yearly_metrics(fact: DataFrame, date: str = "fecha_procesamiento") -> DataFrame:
    return _named_periods(_period_counts(fact, date, [["__year"]]), _year_medians(fact, date))


def quarterly_metrics(fact: DataFrame, date: str = "fecha_procesamiento") -> DataFrame:
    return _named_periods(_period_counts(fact, date, [["__year", "__quarter"]]), None)


def period_table(fact: DataFrame, date: str = "fecha_procesamiento") -> DataFrame:
    """Years and quarters from one pass, and the medians of the years."""
    return _named_periods(_period_counts(fact, date, [["__year"], ["__year", "__quarter"]]), _year_medians(fact, date))


# -- all tables ---------------------------------------------------------------------------


def bi_tables(
    fact: DataFrame,
    as_of: datetime,
    cluster_profile: DataFrame | None = None,
    model_kpis: Mapping[str, float] | None = None,
    date: str = "fecha_procesamiento",
) -> dict[str, DataFrame | None]:
    return {
        "main_data": main_table(fact, as_of.year, as_of.month),
        "kpis": kpi_table(fact, model_kpis),
        "clusters": None if cluster_profile is None else cluster_table(cluster_profile),
        "geography": geography_table(fact),
        "technology": technology_table(fact),
        "time_metrics": settle(period_table(fact, date)),
    }


def export_summary(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Number of tables and of all their rows, as one row."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tabla"), "n")
        for name, df in tables.items()
        if df is not None
    ]
    rows = counts[0]
    for part in counts[1:]:
        rows = rows.unionByName(part)
    return rows.agg(F.count(F.lit(1)).alias("datasets_created"), F.sum("n").alias("total_records"))
