"""Column helpers of the operators that use Spark's own functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once. Spark would paste the expression wherever the name is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def inline_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows stated in code, as a plan without any data behind it."""
    kind = f"array<struct<{', '.join(':'.join(f.split(' ', 1)) for f in schema.split(', '))}>>"
    values = F.array(*[F.struct(*[F.lit(x) for x in row]) for row in rows])
    return spark.range(1).select(F.inline(values.cast(kind)))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
