"""Session settings and the shared folder for cut points."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Settings every job here is written for. All of them can be changed at run time, so they also apply
# to a session somebody else built.
GROUP_LIMIT = 1000
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when the operator above it then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Keep only the first rows of a key in each task before a window's shuffle, for limits up to this;
    # ``reshape.first_rows`` refuses more.
    "spark.sql.optimizer.windowGroupLimitThreshold": str(GROUP_LIMIT),
}


# The innermost open scope of this thread or task of the program.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Set one runtime setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="snowloom-")


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a folder of one
    machine would be lost with that machine, so there the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder()
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove what was written to the shared folder inside the block. Nothing read from there may be
    used afterwards, so end the block only when all results have been stored.

    Scopes may be nested and may be open side by side in several threads: a path belongs to the innermost
    scope of the thread that made it, and to no other.
    """
    made: list[str] = []
    token = _SCOPE.set(made)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in made:
            target = hadoop(path)
            target.getFileSystem(conf).delete(target, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    A columnar table rather than an RDD checkpoint: it is compressed, survives the loss of any
    executor, and a reader that needs one column reads one column.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
