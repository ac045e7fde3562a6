"""Registry of the queries that run the operators on the driver's tables, each with its SQL where one exists."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tamarack.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """``t.orders`` reads the orders table of one scale."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def land(self, df: DataFrame, name: str, kind: str = "text", **options: object) -> str:
        """Writes a stand-in for a downloaded file to the shared folder, for the reader under test."""
        path = f"{shared_folder(self.spark)}/{uuid.uuid4().hex}-{name}"
        df.write.format(kind).options(**options).save(path)
        return path


def query(sql: str | None = None):
    """Registers a function of ``Tables`` under its own name."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder))

        QUERIES[build.__name__] = run
        if sql is not None:
            SQL[build.__name__] = sql
        return build

    return register
