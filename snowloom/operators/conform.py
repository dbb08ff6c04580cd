"""Renaming, typing and cleaning of incoming columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snowloom.functions import as_schema, blank_to_null, decoded, remapped, split_code, typed


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by a map, in one projection."""
    return df.withColumnsRenamed(dict(names))


def cast_to(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The schema's columns in its order; a value that does not fit its type becomes null."""
    columns = []
    for f in as_schema(schema).fields:
        c = F.col(f"`{f.name}`")
        is_text = isinstance(df.schema[f.name].dataType, T.StringType)
        columns.append((typed(c, f.dataType) if is_text else c.try_cast(f.dataType)).alias(f.name))
    return df.select(*columns)


def remap(df: DataFrame, columns: str | Sequence[str], mapping: Mapping[str, str], trim: bool = True) -> DataFrame:
    """Replace listed values of one or more columns by their canonical form.

    The mapping is a list somebody wrote, so it is part of the plan; for a mapping that is itself
    data use ``enrich.lookup``.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    return df.withColumns({c: remapped(c, mapping, trim) for c in columns})


def decode(df: DataFrame, code: str, label: str, labels: Mapping[str, str], default: str | None = "") -> DataFrame:
    return df.withColumn(label, decoded(code, labels, default))


def patch(df: DataFrame, rules: Sequence[tuple[str, Sequence[tuple[Column, str]]]]) -> DataFrame:
    """Correct columns by rules on other columns.

    ``rules`` is an ordered list of (column, [(condition, value), ...]). Within one column the first
    condition that holds wins; a later column sees the corrected earlier ones.
    """
    for column, arms in rules:
        expression = F
        for condition, value in arms:
            expression = expression.when(condition, F.lit(value))
        df = df.withColumn(column, expression.otherwise(F.col(column)))
    return df


def override(
    df: DataFrame, key: str, column: str, mapping: Mapping[str, str], empty_is_null: bool = False
) -> DataFrame:
    """Replace a looked-up value by a listed one for certain keys.

    With ``empty_is_null`` an empty looked-up value becomes null and is not replaced.
    """
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    listed = F.coalesce(F.try_element_at(F.create_map(*pairs), F.trim(F.col(key))), F.col(column))
    if empty_is_null:
        listed = F.when(blank_to_null(column).isNull() & F.col(column).isNotNull(), F.lit(None)).otherwise(listed)
    return df.withColumn(column, listed)


def threshold_split(
    df: DataFrame, code: str, value: str, measure: str, limit: float, low: str, high: str, out: str | None = None
) -> DataFrame:
    return df.withColumn(out or code, split_code(code, value, measure, limit, low, high))


def merge_codes(df: DataFrame, code: str, mapping: Mapping[str, str]) -> DataFrame:
    """Merge several codes into one and keep each resulting row once."""
    return remap(df, code, mapping, trim=False).distinct()


def split_by_type(df: DataFrame, kind: str, source: str, targets: Mapping[str, str]) -> DataFrame:
    """One nullable column per record type, filled only in rows of that type."""
    return df.withColumns({out: F.when(F.col(kind) == value, F.col(source)) for value, out in targets.items()})
