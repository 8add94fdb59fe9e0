"""Sinks for the fact, the BI tables, the run metrics and the check reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.sources.csv import write_csv


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", partition_by: str | None = None
) -> None:
    if fmt == "csv" and partition_by is None:
        write_csv(df, path, mode)
        return
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.save(path)


def write_tables(
    tables: Mapping[str, DataFrame | None], folder: str, fmt: str = "parquet", mode: str = "errorifexists"
) -> dict[str, int]:
    """Write every table that has rows below the folder; return the names written with their rows, counted on the way."""
    written = {}
    for name, df in tables.items():
        # a new table is written and taken back if it has no rows; only one that replaces or joins another is looked at first
        if df is None or (mode != "errorifexists" and df.isEmpty()):
            continue
        path, seen = f"{folder.rstrip('/')}/{name}", Observation(name)
        write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, fmt, mode)
        if seen.get["rows"]:
            written[name] = seen.get["rows"]
        else:
            _remove(df.sparkSession, path)
    return written


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def write_json_document(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One nested document per row, such as the metrics of a run."""
    df.coalesce(1).write.mode(mode).json(path)


def append_report(report: DataFrame, path: str) -> None:
    """Check results of one dataset join those of the others instead of replacing them."""
    report.write.mode("append").parquet(path)
