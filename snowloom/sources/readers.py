"""Reading files, databases, catalog tables and seed rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snowloom.functions import as_schema
from snowloom.operators.conform import cast_to, rename
from snowloom.operators.versioning import latest


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    renames: Mapping[str, str] | None = None,
    separator: str = ",",
    quote: str = '"',
) -> DataFrame:
    """Read a folder of quoted files with one header line into the types of ``schema``.

    Everything is read as text and typed afterwards, so that a value that does not fit becomes null
    and can be counted by ``audit_cast`` instead of failing the load. Columns are taken by position,
    as the header text may differ from the names; ``renames`` then maps names if they must change.
    """
    return cast_to(read_csv_text(spark, path, schema, renames, separator, quote), _renamed(schema, renames))


def read_csv_text(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    renames: Mapping[str, str] | None = None,
    separator: str = ",",
    quote: str = '"',
) -> DataFrame:
    """The same files with every column as text."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in as_schema(schema).fields])
    reader = spark.read.schema(text).option("header", True).option("enforceSchema", True)
    df = reader.option("sep", separator).option("quote", quote).option("escape", "\\").option("multiLine", False)
    return rename(df.csv(path), renames or {})


def _renamed(schema: T.StructType | str, renames: Mapping[str, str] | None) -> T.StructType:
    renames = renames or {}
    return T.StructType([T.StructField(renames.get(f.name, f.name), f.dataType) for f in as_schema(schema).fields])


def read_code_list(spark: SparkSession, path: str, field: str, code: str, value: str) -> DataFrame:
    """Read JSON lines ``{"country": ..., field: ...}`` as two text columns named ``code`` and ``value``."""
    schema = T.StructType([T.StructField("country", T.StringType()), T.StructField(field, T.StringType())])
    return spark.read.schema(schema).json(path).select(F.col("country").alias(code), F.col(field).alias(value))


def jdbc_options(
    url: str,
    table: str,
    key: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    **options: str,
) -> dict[str, str]:
    """Reader options for one table; with a key and its bounds the read is split into ranges."""
    settings = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **options}
    bounds = (key, lower, upper, partitions)
    if any(b is not None for b in bounds):
        if any(b is None for b in bounds):
            raise ValueError("a split read needs key, lower, upper and partitions")
        settings |= {
            "partitionColumn": key,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return settings


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """Read one table of a database; see ``jdbc_options``. Credentials come from the caller."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    return spark.table(name) if spark.catalog.tableExists(name) else None


def current(df: DataFrame, keys: Sequence[str], version: str, ties: str = "one") -> DataFrame:
    """What a consumer reads of a history table, on the first load as on every later one."""
    return latest(df, keys, version, ties)


def seed(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows somebody wrote by hand."""
    return spark.createDataFrame(list(rows), schema)
