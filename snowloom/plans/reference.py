"""Reference tables: distinct values with stable ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowloom.operators import conform, keys
from snowloom.operators.versioning import union_all
from snowloom.plans import fixed_values as fixed


def value_table(values: DataFrame, column: str, id_column: str, prev: DataFrame | None) -> DataFrame:
    """Every value seen so far, with the id it got when it was first seen."""
    named = values.select(column).where(F.col(column).isNotNull())
    frames = [named] if prev is None else [prev.select(column), named]
    return keys.stable_ids(union_all(frames).distinct(), prev, [column], id_column)


def prize_types(laureates: DataFrame, prev: DataFrame | None) -> DataFrame:
    """Prize types with the newest load date of each."""
    new = laureates.select(F.col("prize").alias("prize_type"), "upd_date").where("prize is not null")
    frames = [new] if prev is None else [prev.select("prize_type", "upd_date"), new]
    newest = union_all(frames).groupBy("prize_type").agg(F.max("upd_date").alias("upd_date"))
    return keys.stable_ids(newest, prev, ["prize_type"], "prize_type_id")


def laureate_types(laureates: DataFrame, prev: DataFrame | None) -> DataFrame:
    return value_table(laureates, "laureate_type", "laureate_type_id", prev)


def categories(laureates: DataFrame, prev: DataFrame | None) -> DataFrame:
    return value_table(laureates, "category", "category_id", prev)


def genders(laureates: DataFrame, prev: DataFrame | None) -> DataFrame:
    return value_table(laureates, "gender", "gender_id", prev)


def regions(countries: DataFrame, prev: DataFrame | None) -> DataFrame:
    return value_table(countries.select(F.col("region").alias("region_name")), "region_name", "region_id", prev)


def continents(continent_list: DataFrame, prev: DataFrame | None) -> DataFrame:
    codes = value_table(continent_list, "continent_code", "continent_id", prev)
    named = conform.decode(codes, "continent_code", "continent_name", fixed.CONTINENT_NAMES)
    return named.select("continent_id", "continent_name", "continent_code")


def currencies(currency_list: DataFrame, prev: DataFrame | None) -> DataFrame:
    return value_table(currency_list.where("currency_code != ''"), "currency_code", "currency_code_id", prev)
