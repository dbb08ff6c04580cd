"""Checks of keys, references, nulls and types. Each gives the findings as a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snowloom.functions import as_schema, trimmed, typed


def audit_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, and how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def audit_fk(
    child: DataFrame, foreign: Sequence[str], parents: Sequence[tuple[DataFrame, Sequence[str]]]
) -> DataFrame:
    """Foreign keys found in none of the parents, and the number of rows holding each.

    The child is counted per key first, so the anti-join sees every key once however heavy it is. A
    key with a null part refers to nothing and is no finding.
    """
    keys = [f"__k{i}" for i in range(len(foreign))]
    known = reduce(
        DataFrame.union, [p.select(*[F.col(c).alias(k) for c, k in zip(cols, keys)]) for p, cols in parents]
    ).distinct()
    counted = child.dropna(subset=list(foreign)).groupBy(*foreign).agg(F.count(F.lit(1)).alias("n"))
    condition = reduce(lambda a, b: a & b, [F.col(c) == F.col(k) for c, k in zip(foreign, keys)])
    return counted.join(known, condition, "left_anti")


def _one_row_per_column(df: DataFrame, names: Sequence[str], measures: dict[str, list]) -> DataFrame:
    """Aggregate once over the whole frame, then turn the single row into one row per column."""
    flat = [agg.alias(f"__{m}_{i}") for m, aggs in measures.items() for i, agg in enumerate(aggs)]
    rows = [
        F.struct(F.lit(name).alias("column_name"), *[F.col(f"__{m}_{i}").alias(m) for m in measures])
        for i, name in enumerate(names)
    ]
    return df.agg(*flat).select(F.inline(F.array(*rows)))


def audit_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The number of nulls in each column, in one pass."""
    return _one_row_per_column(df, columns, {"nulls": [F.count_if(F.col(c).isNull()) for c in columns]})


def audit_cast(df: DataFrame, schema: T.StructType | str, lengths: dict[str, int] | None = None) -> DataFrame:
    """Per column, texts that do not fit the declared type and texts longer than declared."""
    fields, lengths = as_schema(schema).fields, lengths or {}
    never = F.count_if(F.lit(False))
    bad, long = [], []
    for f in fields:
        c = F.col(f.name)
        bad.append(F.count_if(c.isNotNull() & typed(c, f.dataType).isNull()))
        long.append(F.count_if(F.length(c) > lengths[f.name]) if f.name in lengths else never)
    return _one_row_per_column(df, [f.name for f in fields], {"bad_casts": bad, "too_long": long})


def unmatched(df: DataFrame, dim: DataFrame, column: str, dim_column: str) -> DataFrame:
    """The names the dimension does not know, and the number of rows holding each."""
    named = df.where(F.col(column).isNotNull()).select(trimmed(df, column).alias(column))
    counted = named.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(trimmed(dim, dim_column).alias("__known")).distinct()
    return counted.join(known, F.col(column) == F.col("__known"), "left_anti")


@dataclass(frozen=True)
class Check:
    """What must hold of a table: ``unique`` columns, ``required`` ones, or a ``reference`` into any of the parents."""

    table: str
    kind: str
    columns: Sequence[str]
    parents: Sequence[tuple[str, Sequence[str]]] = ()

    def __post_init__(self) -> None:
        if self.kind not in ("unique", "required", "reference"):
            raise ValueError("a check is 'unique', 'required' or 'reference'")
        if (self.kind == "reference") != bool(self.parents):
            raise ValueError("a reference, and nothing else, has parents")


def _key(columns: Sequence[str]) -> Column:
    """The values of some columns as one text, nulls told from texts."""
    return F.to_json(F.array(*[F.col(c).cast("string") for c in columns]), {"ignoreNullFields": "false"})


def audit_tables(frames: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """All findings of all checks: ``check`` (its number), ``table_name, kind, column_names, key, n``.

    ``key`` is the list of values as JSON (of a required column its name), ``n`` the number of rows that have it. Every table
    is scanned once, whatever is checked of it or against it: a row gives the keys that it has in each check, as a
    child or as a parent, and one sum over check and key, begun in every task, tells which keys are
    repeated or refer to nothing. A key with a null part refers to nothing and is no finding.
    """
    if missing := ({c.table for c in checks} | {p for c in checks for p, _ in c.parents}) - set(frames):
        raise ValueError(f"no rows of {', '.join(sorted(missing))}")
    sides = []
    for table, frame in frames.items():
        said = []
        for i, check in enumerate(checks):
            if check.table == table and check.kind == "required":
                said += [F.when(F.col(c).isNull(), _said(i, F.lit(c), 1, False)) for c in check.columns]
            elif check.table == table:
                whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in check.columns])
                found = _said(i, _key(check.columns), 1, False)
                said.append(F.when(whole, found) if check.kind == "reference" else found)
            for parent, columns in check.parents:
                if parent == table:
                    said.append(_said(i, _key(columns), 0, True))
        if said:
            sides.append(frame.select(F.explode(F.array_compact(F.array(*said))).alias("x")).select("x.*"))
    told = reduce(DataFrame.union, sides).groupBy("check", "key").agg(F.sum("n").alias("n"), F.max("parent").alias("parent"))
    kinds = F.array(*[F.lit(c.kind) for c in checks])
    kind = F.get(kinds, F.col("check"))
    wrong = F.when(kind == "unique", F.col("n") > 1).when(kind == "required", F.col("n") > 0).otherwise((F.col("n") > 0) & ~F.col("parent"))
    names = [F.get(F.array(*map(F.lit, xs)), F.col("check")) for xs in ([c.table for c in checks], [",".join(c.columns) for c in checks])]
    return told.where(wrong).select("check", names[0].alias("table_name"), kind.alias("kind"), names[1].alias("column_names"), "key", "n")


def _said(check: int, key: Column, n: int, parent: bool) -> Column:
    return F.struct(F.lit(check).alias("check"), key.alias("key"), F.lit(n).cast("long").alias("n"), F.lit(parent).alias("parent"))
