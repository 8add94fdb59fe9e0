"""What the operators of this subpackage share on the side of Spark."""

from __future__ import annotations

import pickle

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from millrace.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a result of big jobs to the shared folder and read it back.

    Later steps read columns of it instead of doing the work again, and a lost executor costs
    no more than the tasks it was running.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Shared:
    """An object of bounded size sent to all executors once, with the code of its class."""

    def __init__(self, spark: SparkSession, what):
        self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(what))

    def get(self):
        return pickle.loads(self.sent.value)
