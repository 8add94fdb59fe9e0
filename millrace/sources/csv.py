"""CSV scan and sink."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import settle, written

# Texts that mean "no value" in a CSV field.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
#: Lines of one record, at most.
MAX_LINES = 100_000
SURPLUS = "__surplus"
NUMBER = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|[iI]nf(inity)?)\s*$"


def _field(c: str, target: T.DataType | None, null_tokens: Sequence[str]) -> Column:
    value = F.when(~F.col(f"`{c}`").isin(*null_tokens), F.col(f"`{c}`"))
    if target is None or isinstance(target, T.StringType):
        return value.alias(c)
    return value.try_cast(target).alias(c)


def infer_schema(texts: DataFrame) -> T.StructType:
    """Type per column from one aggregate over all rows: long, double, boolean or string."""
    kinds = (("long", T.LongType()), ("double", T.DoubleType()), ("boolean", T.BooleanType()))
    aggregates = []
    for i, c in enumerate(texts.columns):
        col = F.col(f"`{c}`")
        fits = {
            "long": col.try_cast("long").isNotNull(),
            "double": col.rlike(NUMBER),
            "boolean": F.lower(col).isin("true", "false"),
        }
        aggregates.append(F.count(col).alias(f"n{i}"))
        aggregates += [F.count_if(col.isNotNull() & ~fits[name]).alias(f"{name}{i}") for name, _ in kinds]
    row = texts.agg(*aggregates).first()
    fields = []
    for i, c in enumerate(texts.columns):
        fitting = [kind for name, kind in kinds if row[f"n{i}"] and row[f"{name}{i}"] == 0]
        fields.append(T.StructField(c, fitting[0] if fitting else T.StringType()))
    return T.StructType(fields)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their place: ``file, block`` (where the split of the file starts), ``line`` (grows within a split)."""
    place = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(path).select(
        place["file_path"].alias("file"),
        place["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
        (F.length("value") - F.length(F.replace("value", F.lit('"')))).alias("quotes"),
    )


def breaks_in_quotes(spark: SparkSession, path: str) -> bool:
    """Whether a line of the files ends inside quotes, from one scan that stops at the first one."""
    return not _lines(spark, path).where("quotes % 2 = 1").select("file").limit(1).isEmpty()


def csv_records(spark: SparkSession, path: str, max_lines: int = MAX_LINES) -> DataFrame:
    """Records of CSV files as text, ``file, first, record``: those whose quotes hold line breaks are put together from their lines.

    A line ends a record if the quotes of the file up to its end are even; a quote within quotes is written twice. The files
    stay splittable: a first pass counts quotes within each split, the parity at the start of a split is a sum over
    the splits before it (a row each), and only the lines of records with several are grouped. A record of more than ``max_lines`` lines is
    an error (a quote that is never closed would take the rest of the file). Quotes inside of a field without quotes are not
    allowed here. ``first`` marks the header record of a file.
    """
    split = Window.partitionBy("file", "block").orderBy("line")
    before = split.rowsBetween(Window.unboundedPreceding, -1)
    lines = _lines(spark, path).withColumn("odd", F.col("quotes") % 2 == 1)
    # parity as if the split began outside of quotes; lines that open a record of several lines, for either beginning
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    opens = {f"opens{s}": F.sum(F.when(F.col("odd") & (F.col("inside") == s), 1).otherwise(0)).over(split) for s in (0, 1)}
    top = (F.col("block") == 0) & (F.row_number().over(split) == 1)
    numbered = written(lines.withColumns({"inside": inside, "top": top}).withColumns(opens).drop("odd"), "csv-lines")

    splits = numbered.groupBy("file", "block").agg(F.sum("quotes").alias("q"), F.max("opens0").alias("o0"), F.max("opens1").alias("o1"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = splits.withColumn("begins", F.coalesce(F.sum("q").over(earlier), F.lit(0)) % 2)
    opened = F.sum(F.when(F.col("begins") == 0, F.col("o0")).otherwise(F.col("o1"))).over(earlier)
    begun = settle(begun.select("file", "block", "begins", F.coalesce(opened, F.lit(0)).alias("opened")))

    met = numbered.join(begun, ["file", "block"])
    from_open = (F.col("inside") + F.col("begins")) % 2
    number = F.col("opened") + F.when(F.col("begins") == 0, F.col("opens0")).otherwise(F.col("opens1"))
    met = met.select("file", "block", "line", "value", "top", from_open.alias("within"), (F.col("quotes") % 2 == 1).alias("odd"), number.alias("record"))
    whole = met.where("within = 0 AND NOT odd").select("file", F.col("top").alias("first"), F.col("value").alias("record"))
    several = met.where("within = 1 OR odd")
    long = several.groupBy("file", "record").count().where(F.col("count") > max_lines).select("file", "count").first()
    if long:
        raise ValueError(f"{long['file']}: a record of {long['count']} lines, more than {max_lines}; is a quote not closed?")
    parts = F.sort_array(F.collect_list(F.struct("block", "line", "value")))
    joined = several.groupBy("file", "record").agg(F.max("top").alias("first"), F.array_join(F.transform(parts, lambda x: x["value"]), "\n").alias("text"))
    records = whole.unionByName(joined.select("file", "first", F.col("text").alias("record")))
    clean = F.regexp_replace(F.when(F.col("first"), F.ltrim("record", F.lit("\ufeff"))).otherwise(F.col("record")), "\r$", "")
    return records.withColumn("record", clean).where(F.trim("record") != "")


def _read_records(spark: SparkSession, path: str, names: Sequence[str] | None, max_lines: int) -> DataFrame:
    records = csv_records(spark, path, max_lines)
    if names is None:
        header = records.where("first").orderBy("file").select("record").first()
        if header is None:
            raise ValueError(f"{path}: no header")
        names = next(csv.reader([header[0]], strict=True))
    # the parser joins what one record holds, line breaks included; no record of a file reaches it in parts
    fields = F.from_csv("record", _ddl(names), {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1"})
    return records.where("NOT first").select(fields.alias("f")).select("f.*")


def _ddl(names: Sequence[str]) -> str:
    """Columns of text, and one more for what a row has too much."""
    return ", ".join(f"`{n.replace('`', '``')}` STRING" for n in [*names, SURPLUS])


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    null_tokens: Sequence[str] = NA_TOKENS,
    multi_line: bool | None = None,
    surplus: str = "error",
    max_lines: int = MAX_LINES,
) -> DataFrame:
    """Read a CSV with header. Fields that hold a null token, or do not fit the declared
    type, are null. Without a schema the types come from one extra pass over the data.

    ``multi_line``: whether quotes may hold line breaks; by default a scan looks for them. Such files stay splittable
    (``csv_records``). Rows with fewer fields than columns end in nulls; rows with more are an error unless these
    are empty, with ``surplus="drop"`` their last fields go.
    """
    if surplus not in ("error", "drop"):
        raise ValueError("surplus is error or drop")
    names = None if schema is None else [f.name for f in schema.fields]
    if breaks_in_quotes(spark, path) if multi_line is None else multi_line:
        texts = _read_records(spark, path, names, max_lines)
    else:
        reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
        names = names or reader.csv(path).columns
        texts = reader.schema(_ddl(names)).csv(path)
    names = texts.columns[:-1]
    if surplus == "error":
        # within the columns and not a filter, which Spark would move below the join of lines and splits
        told = F.raise_error(F.concat(F.lit(f"{path}: a row has more than {len(names)} fields, the next is "), F.col(SURPLUS)))
        texts = texts.select(*[F.when(F.length(SURPLUS) > 0, told.cast("string")).otherwise(F.col(f"`{c}`")).alias(c) for c in names])
    texts = texts.select(*[f"`{c}`" for c in names])
    texts = texts.select(*[_field(c, None, null_tokens) for c in texts.columns])
    schema = schema or infer_schema(texts)
    return texts.select(*[_field(f.name, f.dataType, null_tokens) for f in schema.fields])


def tag_source(df: DataFrame, tag: str) -> DataFrame:
    return df.withColumn("source", F.lit(tag))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
