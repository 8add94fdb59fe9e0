"""The two published runs: three sources with all stages, and two sources up to the load.

Each stage writes its tables and the next one reads them back. So nothing is worked out twice,
a lost executor costs no more than the stage it was in, and later stages read columns instead of
raw text.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import MiningLimits, Thresholds
from millrace.operators import clean, marts, mining, validate, warehouse
from millrace.operators.transform import transform_frame
from millrace.plans import sources as S
from millrace.sources.csv import NA_TOKENS, scan_csv, tag_source
from millrace.sources.sinks import append_report, write_json_document, write_table, write_tables


@dataclass(frozen=True)
class SourceFile:
    """One input: where it is, how to clean and transform it, what to check."""

    path: str
    cleaning: Mapping
    validation: Mapping
    transformation: Mapping | None = None
    schema: object = None


def three_sources(jobs: str, investments: str, profiles: str) -> dict[str, SourceFile]:
    return {
        "jobs": SourceFile(jobs, S.JOBS_CLEANING, {"business_rules": S.JOBS_RULES}),
        "investment": SourceFile(investments, S.INVESTMENTS_CLEANING, {}),
        "profiles": SourceFile(profiles, S.PROFILES_CLEANING, {"business_rules": S.PROFILES_RULES}),
    }


def prepare(
    spark: SparkSession, source: SourceFile, null_tokens=NA_TOKENS, thresholds: Thresholds = Thresholds()
) -> tuple[DataFrame, int]:
    """Prepared form of a source, and how many rows its files have."""
    raw = scan_csv(spark, source.path, source.schema, null_tokens)
    rows, read, _ = clean.deduplicate_counted(clean.nan_as_null(raw))
    prepared = clean.clean_frame(rows, source.cleaning, z=thresholds.outlier_z, deduplicated=True)
    return transform_frame(prepared, source.transformation), read


def load_sources(
    spark: SparkSession, files: Mapping[str, SourceFile], out: str, thresholds: Thresholds = Thresholds()
) -> tuple[dict[str, int], dict[str, DataFrame]]:
    """Prepare and write every source; return how many rows each had, and the written tables."""
    read, loaded = {}, {}
    for name, source in files.items():
        prepared, read[name] = prepare(spark, source, thresholds=thresholds)
        path = f"{out}/processed/{name}"
        write_table(tag_source(prepared, name), path)
        loaded[name] = spark.read.parquet(path)
    return read, loaded


def validate_sources(
    spark: SparkSession,
    files: Mapping[str, SourceFile],
    loaded: Mapping[str, DataFrame],
    out: str,
    thresholds: Thresholds,
    as_of: datetime,
) -> DataFrame:
    """Append the report of every source to one table and read it back."""
    path = f"{out}/validation"
    for name, source in files.items():
        report = validate.validation_report(
            loaded[name].drop("source"), source.validation, S.SOURCE_TAGS[name], thresholds, as_of
        )
        append_report(validate.translate_status(report), path)
    return spark.read.parquet(path)


def run_metrics(
    raws: Mapping[str, DataFrame | int],
    loaded: Mapping[str, DataFrame | int],
    reports: DataFrame,
    run_time: datetime,
    fact: DataFrame | None = None,
    extra: Mapping[str, str] | None = None,
    summary: DataFrame | None = None,
    exported: Mapping[str, int] | None = None,
) -> DataFrame:
    """One nested row: records, verdicts, quality and duplicates removed. ``extra`` are texts.

    ``raws`` and ``loaded`` are numbers of rows, or tables to be counted. Verdicts and score come from one pass over the reports.
    With a fact its summary (``seccion, metrica, clave, valor``) becomes a section, with the rows of the
    exported tables their number and all their rows.
    """
    names = {name: S.SOURCE_TAGS.get(name, name) for name in loaded}

    def count(rows: DataFrame | int) -> Column:
        return F.lit(rows).cast("long") if isinstance(rows, int) else rows.agg(F.count(F.lit(1))).scalar()

    def verdict(dataset: str) -> Column:
        own = F.when((F.col("dataset") == dataset) & (F.col("part") == "overall"), F.col("status"))
        return F.coalesce(F.max(own), F.lit("unknown"))

    scored = F.when((F.col("part") == "completeness") & (F.col("check") == "score"), F.col("value"))
    found = reports.agg(F.avg(scored).alias("score"), *[verdict(tag).alias(f"__is_{tag}") for tag in names.values()])
    score = F.struct((F.rint(F.col("score") * 100.0) / 100.0).alias("score"), validate.quality_band(F.col("score")).alias("band"))
    row = found.withColumns(
        {"q": score}
        | {f"__in_{tag}": count(raws[name]) for name, tag in names.items()}
        | {f"__out_{tag}": count(loaded[name]) for name, tag in names.items()}
    )
    processed = [F.col(f"__out_{tag}").alias(tag) for tag in names.values()]
    total = sum((F.col(f"__out_{tag}") for tag in names.values()), F.lit(0)).alias("total_registros")
    if fact is not None:
        row = row.withColumn("__fact", count(fact))
        processed.append(F.col("__fact").alias("warehouse_consolidado"))
    sections = {}
    if summary is not None:
        entry = F.struct("seccion", "metrica", "clave", "valor")
        sections["warehouse_consolidado"] = summary.agg(F.sort_array(F.collect_list(entry))).scalar()
    if exported is not None:
        sections["exportacion"] = F.struct(
            F.lit(len(exported)).cast("long").alias("datasets_created"),
            F.lit(sum(exported.values())).cast("long").alias("total_records"),
        )
    removed = [(F.col(f"__in_{tag}") - F.col(f"__out_{tag}")).alias(tag) for tag in names.values()]
    return row.select(
        F.lit(run_time.isoformat()).alias("fecha_ejecucion"),
        F.struct(*processed, total, F.lit(run_time.isoformat()).alias("fecha_procesamiento"), F.col("q.score").alias("puntuacion_calidad_datos")).alias("registros_procesados"),
        F.struct(*[F.col(f"__is_{tag}").alias(tag) for tag in names.values()]).alias("resultados_validacion"),
        F.struct(F.col("q.band").alias("estado_general"), F.struct(*removed).alias("duplicados_eliminados")).alias(
            "resumen_calidad"
        ),
        *[section.alias(name) for name, section in sections.items()],
        *[F.lit(text).alias(name) for name, text in (extra or {}).items()],
    )


def run_three_sources(
    spark: SparkSession,
    files: Mapping[str, SourceFile],
    out: str,
    run_time: datetime,
    thresholds: Thresholds = Thresholds(),
    limits: MiningLimits = MiningLimits(),
    date: str = "fecha_procesamiento",
    bi_format: str = "csv",
) -> DataFrame:
    """Extract, clean, transform, unify, mine, validate, load and export; return the metrics.

    Below ``out`` stand ``processed``, ``fact`` (partitioned by source), ``summary``,
    ``validation``, ``bi`` and ``metrics``.
    """
    import json

    out = out.rstrip("/")
    read, loaded = load_sources(spark, files, out, thresholds)

    built = warehouse.build_fact(loaded["jobs"], loaded["investment"], loaded["profiles"], run_time)
    write_table(built, f"{out}/fact", partition_by="fuente_datos")
    fact = spark.read.schema(built.schema).parquet(f"{out}/fact")
    write_table(warehouse.warehouse_summary(fact), f"{out}/summary")

    results = mining.run_analyses(fact, limits, run_time)
    write_table(mining.mining_summary(spark, results), f"{out}/mining")
    reports = validate_sources(spark, files, loaded, out, thresholds, run_time)

    profile, models = None, {}
    clusters = results["analisis_realizados"]["clustering"]
    if "clusters" in clusters:
        models["clusters"] = clusters["num_clusters"]
        profile = spark.createDataFrame(clusters["clusters"])
    classified = results["analisis_realizados"]["clasificacion"]
    if "modelo_random_forest" in classified:
        models["accuracy"] = classified["modelo_random_forest"]["precision"]
    tables = marts.bi_tables(fact, run_time, profile, models, date)
    written = write_tables(tables, f"{out}/bi", bi_format)

    metrics = run_metrics(
        read, loaded, reports, run_time, fact,
        {"tablas_bi": ",".join(written), "analisis_mineria_datos": json.dumps(results, ensure_ascii=False)},
        spark.read.parquet(f"{out}/summary"), written,
    )
    write_json_document(metrics, f"{out}/metrics")
    return spark.read.json(f"{out}/metrics")


def run_two_sources(
    spark: SparkSession,
    files: Mapping[str, SourceFile],
    out: str,
    run_time: datetime,
    thresholds: Thresholds = Thresholds(),
) -> DataFrame:
    """Clean, transform, validate and load, without warehouse, mining and export."""
    out = out.rstrip("/")
    read, loaded = load_sources(spark, files, out, thresholds)
    reports = validate_sources(spark, files, loaded, out, thresholds, run_time)
    write_json_document(run_metrics(read, loaded, reports, run_time), f"{out}/metrics")
    return spark.read.json(f"{out}/metrics")
