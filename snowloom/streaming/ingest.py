"""Landing files as they arrive."""

from __future__ import annotations

import hashlib
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snowloom.sinks.tables import Layout, land, stamp


def land_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    batch_date: date | str | None = None,
    format: str = "parquet",
    options: dict[str, str] | None = None,
    max_files: int | None = None,
) -> None:
    """Land every file not landed before, then stop. Running it again without new files adds nothing.

    A micro-batch that is repeated after a failure carries the same number, and that number is part of
    the partition it replaces, so a repeat leaves one copy.
    """
    reader = spark.readStream.schema(schema).format(format).options(**(options or {}))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def write(batch: DataFrame, number: int) -> None:
        rows = stamp(batch, batch_date).withColumn("load_id", F.lit(number).cast("long"))
        writer = rows.write.partitionBy("upd_date", "load_id").mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").orc(target)

    query = (
        reader.load(source)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def land_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    table: str,
    checkpoint: str,
    batch_date: date | str,
    format: str = "parquet",
    options: dict[str, str] | None = None,
    max_files: int | None = None,
    index: list[str] | None = None,
) -> None:
    """Land every file not landed before in a landing table that runs read, then stop.

    Each micro-batch is one landing: a partition of its own beside others of the date, noted for ``sinks.pin``. Its number
    follows from the stream's checkpoint and the micro-batch, so one that is repeated after a failure replaces itself,
    on whatever date, and is not new to a run that has consumed it: every file counts exactly once.
    """
    reader = spark.readStream.schema(schema).format(format).options(**(options or {}))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def write(batch: DataFrame, number: int) -> None:
        land(batch, table, batch_date, Layout(("upd_date", "landing")), landing_number(checkpoint, number), index or ())

    stream = reader.load(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    stream.trigger(availableNow=True).start().awaitTermination()


def landing_number(checkpoint: str, batch: int) -> int:
    """One number for a micro-batch of a stream, whenever and wherever it runs."""
    return int.from_bytes(hashlib.sha256(f"{checkpoint}#{batch}".encode()).digest()[:8], "big") >> 1


def landed(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """What has been landed, with the load date."""
    full = T.StructType([*schema.fields, T.StructField("upd_date", T.DateType()), T.StructField("load_id", T.LongType())])
    return spark.read.schema(full).orc(target).drop("load_id")
