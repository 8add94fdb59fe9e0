"""A corpus pipeline in five stages, each one operator of ``millrace.llm`` over all that the stage before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of ``documents``; the last one returns
the mix: those columns and how many words it takes of each document. Null texts are rejected by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import language, mixing, neartexts, pii, tiling
from millrace.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Texts are near-duplicates from this similarity of their five-word shingles on.
ALIKE = 0.8
#: A document goes if its language is less sure than this.
LEAST_SURE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a language; its prediction fills a missing lang. Learns from the table of documents."""
    network = language.train(table(spark, sf_dir, "documents"))
    found = language.predict(docs, network, COLUMNS)
    sure = found.filter((F.col("lang_pred") != language.UND) & (F.col("score") >= LEAST_SURE))
    return sure.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return neartexts.keep_one(docs.select(*COLUMNS), least=ALIKE)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a test of the benchmark."""
    return tiling.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind in place of each personal datum; n_chars follows the text."""
    masked = pii.redact(docs, [c for c in COLUMNS if c != "text"])
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs, mixing.quality_weights(table(spark, sf_dir, "labels")))


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("pii", mask_pii),
    ("mix", mix_sources),
]

#: The stages are models and searches that SQL does not have; the tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written and read again, so a lost executor costs one stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
