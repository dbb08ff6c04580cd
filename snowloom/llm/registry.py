"""Queries of this subpackage: name to function, and the SQL of those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import snowloom
from snowloom.queries.registry import Tables
from snowloom.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# Texts are long, so batches sent to Python are short.
BATCH_ROWS = "512"


def prepare(spark: SparkSession) -> SparkSession:
    """The settings the operators are written for, and this package on the path of Python workers that run
    where it lies; elsewhere it comes with the job, as any package does (``--py-files``)."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    root, env = str(Path(snowloom.__file__).resolve().parent.parent), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return spark


def query(sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(prepare(spark), folder))

        run.__name__, run.__doc__ = build.__name__, build.__doc__
        QUERIES[build.__name__] = run
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return register
