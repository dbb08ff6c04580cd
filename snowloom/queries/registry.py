"""The list of queries over the given tables and the SQL that states the expected result of each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from snowloom.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_SCHEMAS: dict[str, StructType] = {}


class Tables:
    """The given tables of one folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        # The schema of a file is read once per process; every further read of it needs no job.
        path = self.path(name)
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)


def query(sql: str):
    """Register a function of the given tables together with its SQL."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(tune(spark), folder))

        name = build.__name__
        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        ORACLES[name] = sql
        return build

    return register
