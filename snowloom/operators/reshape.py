"""Collapsing rows per key, slots, entities and bridges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snowloom.session import GROUP_LIMIT

from snowloom.operators.keys import attach_ids, dense_id


def collapse(
    df: DataFrame, keys: Sequence[str], min_cols: Sequence[str] = (), max_cols: Sequence[str] = ()
) -> DataFrame:
    """One row per key with the lowest or highest value of each column, nulls left out."""
    return df.groupBy(*keys).agg(
        *[F.min(c).alias(c) for c in min_cols], *[F.max(c).alias(c) for c in max_cols]
    )


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int, number: str) -> DataFrame:
    """The first ``n`` rows of each key in the given order, numbered from 1.

    Because of the limit Spark keeps at most ``n`` rows per key in each task before the shuffle, so a
    heavy key never reaches one task whole. More than ``GROUP_LIMIT`` rows would be beyond that, and are refused.
    """
    if n > GROUP_LIMIT:
        raise ValueError(f"at most {GROUP_LIMIT} rows per key")
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(number, F.row_number().over(window)).where(F.col(number) <= n)


def slots(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], cols: Sequence[str], n: int) -> DataFrame:
    """Pivot the first ``n`` rows of each key into numbered columns ``col1 .. coln``."""
    return pivot_slots(first_rows(df, keys, order, n, "__slot"), keys, "__slot", cols, n)


def pivot_slots(df: DataFrame, keys: Sequence[str], number: str, cols: Sequence[str], n: int) -> DataFrame:
    """Turn rows numbered 1 to ``n`` within their key into numbered columns.

    A number occurs once per key, so a slot is taken as one struct and not column by column.
    """
    slot = F.struct(*cols)
    taken = df.groupBy(*keys).agg(*[F.min(F.when(F.col(number) == i, slot)).alias(f"__{i}") for i in range(1, n + 1)])
    return taken.select(*keys, *[F.col(f"__{i}.{c}").alias(f"{c}{i}") for i in range(1, n + 1) for c in cols])


def collapse_with_slots(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    slot_cols: Sequence[str],
    n: int,
    min_cols: Sequence[str] = (),
    max_cols: Sequence[str] = (),
) -> DataFrame:
    """One row per key: collapsed columns over all rows, and slots of the first ``n`` rows.

    Two reductions that each shrink the data before their shuffle, joined on the key they are both
    already partitioned by.
    """
    keyed = as_one_key(df, keys)
    whole = collapse(keyed, [KEY], min_cols, max_cols)
    return split_key(whole.join(slots(keyed, [KEY], order, slot_cols, n), KEY, "left"), keys)


KEY = "__key"


def as_one_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys as one struct. Structs are equal when their fields are, nulls included, so frames
    grouped by it join by plain equality and keep their partitioning."""
    return df.withColumn(KEY, F.struct(*keys)).drop(*keys)


def split_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"{KEY}.{k}").alias(k) for k in keys], *[c for c in df.columns if c != KEY])


def entity(df: DataFrame, cols: Sequence[str] | Mapping[str, str], where: Column | str | None = None) -> DataFrame:
    """The distinct rows of one entity of a wide table."""
    rows = df if where is None else df.where(where)
    if isinstance(cols, Mapping):
        return rows.select(*[F.col(source).alias(name) for source, name in cols.items()]).distinct()
    return rows.select(*cols).distinct()


def normalise(
    df: DataFrame, dims: Mapping[str, tuple[str, Sequence[str]]]
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Split a wide table into dimensions with ids and a fact that holds the ids.

    ``dims`` maps a dimension's name to its id column and its columns.
    """
    tables = {}
    for name, (id_column, cols) in dims.items():
        tables[name] = dense_id(entity(df, cols), cols, id_column)
    fact = df
    for name, (id_column, cols) in dims.items():
        fact = attach_ids(fact, tables[name], cols, id_column)
    moved = {c for _, cols in dims.values() for c in cols}
    return fact.select(*[c for c in fact.columns if c not in moved]), tables


def bridge(df: DataFrame, left: str, right: str, id_column: str) -> DataFrame:
    """The distinct pairs of two ids, with an id of their own."""
    return dense_id(df.select(left, right).distinct(), [left, right], id_column)
