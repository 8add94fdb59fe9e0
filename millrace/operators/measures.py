"""Queries that dashboards put to the BI tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.lookup import join_lookup, scalars


def star_join(fact: DataFrame, geography: DataFrame, technology: DataFrame) -> DataFrame:
    """Fact with its country's and its language's figures, both many to one."""
    geo = geography.select(
        "pais_normalizado", "Region", F.col("Ranking_Salario"), F.col("Salario_Promedio").alias("Salario_Pais")
    )
    tech = technology.where("Tipo = 'Lenguaje'").select(
        F.col("Tecnologia").alias("tecnologia_principal"), "Popularidad_Rank", "Total_Menciones"
    )
    return join_lookup(join_lookup(fact, geo, ["pais_normalizado"]), tech, ["tecnologia_principal"])


def cluster_join(assigned: DataFrame, clusters: DataFrame) -> DataFrame:
    """Records with the figures of their cluster (``cluster_asignado`` = ``Cluster_ID``)."""
    named = clusters.withColumnRenamed("Cluster_ID", "cluster_asignado")
    return join_lookup(assigned, named, ["cluster_asignado"])


def basic_measures(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count("id_registro").alias("total_profesionales"), F.avg("salario_usd").alias("salario_promedio")
    )


def salary_gap(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return fact.groupBy(*by).agg((F.max("salario_usd") - F.min("salario_usd")).alias("brecha_salarial"))


def top_country(geography: DataFrame) -> DataFrame:
    return geography.orderBy(F.desc_nulls_last("Salario_Promedio"), "pais_normalizado").limit(1)


def top_countries(geography: DataFrame, k: int = 10) -> DataFrame:
    return geography.orderBy(F.desc("Total_Registros"), "pais_normalizado").limit(k)


def monthly_growth(df: DataFrame, date: str, record: str) -> DataFrame:
    """Records per month and growth over the calendar month before (null without one).

    The months are counted first; each then meets its predecessor by an equi-join.
    """
    months = df.groupBy(F.date_trunc("month", date).cast("date").alias("mes")).agg(F.count(record).alias("registros"))
    before = months.select(F.add_months("mes", 1).alias("mes"), F.col("registros").alias("previos"))
    joined = months.where(F.col("mes").isNotNull()).join(before, "mes", "left")
    growth = F.try_divide((F.col("registros") - F.col("previos")).cast("double"), F.col("previos").cast("double"))
    return joined.select("mes", "registros", growth.alias("tasa_crecimiento"))


def source_share(fact: DataFrame, source: str = "fuente_datos") -> DataFrame:
    """Records per source and their share of all, in percent."""
    counts = fact.groupBy(source).agg(F.count(F.lit(1)).alias("registros"))
    total = scalars(fact, n=F.count(F.lit(1)))["n"]
    return counts.withColumn("porcentaje", F.col("registros") * F.lit(100.0) / total)


def monthly_by_source(df: DataFrame, date: str, source: str, amount: str) -> DataFrame:
    return df.groupBy(F.date_trunc("month", date).cast("date").alias("Fecha"), F.col(source).alias("Fuente_Datos")).agg(
        F.count(F.lit(1)).alias("Registros_Mes"), F.avg(amount).alias("Salario_Promedio_Mes")
    )


def filter_fact(
    fact: DataFrame,
    countries: Sequence[str] | None = None,
    sources: Sequence[str] | None = None,
    salary_bands: Sequence[str] | None = None,
    salary_between: tuple[float, float] | None = None,
    year: int | None = None,
    month: int | None = None,
    date: str = "fecha_referencia",
) -> DataFrame:
    """Dashboard filters; each one given narrows the rows."""
    for column, values in (
        ("pais_normalizado", countries), ("fuente_datos", sources), ("rango_salario", salary_bands),
    ):
        if values is not None:
            fact = fact.where(F.col(column).isin(*values))
    if salary_between is not None:
        fact = fact.where(F.col("salario_usd").between(*salary_between))
    if year is not None:
        fact = fact.where(F.year(date) == year)
    if month is not None:
        fact = fact.where(F.month(date) == month)
    return fact


def drill_rollup(fact: DataFrame, levels: Sequence[str] = ("pais_normalizado", "ciudad_normalizada")) -> DataFrame:
    """Figures per level of the drill path, down from the total; ``nivel`` tells the depth."""
    depth = F.lit(len(levels)) - sum((F.grouping(c) for c in levels), F.lit(0))
    return fact.rollup(*levels).agg(
        depth.cast("int").alias("nivel"),
        F.count("id_registro").alias("registros"),
        F.avg("salario_usd").alias("salario_promedio"),
    )


def individuals(fact: DataFrame, country: str, city: str) -> DataFrame:
    """Last step of the drill: the records of one city."""
    return fact.where((F.col("pais_normalizado") == country) & (F.col("ciudad_normalizada") == city))
