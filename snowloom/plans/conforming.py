"""Conforming of names before anything is looked up by them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowloom.functions import joined_when
from snowloom.operators import conform, enrich
from snowloom.plans import fixed_values as fixed


def conform_countries(countries: DataFrame) -> DataFrame:
    """Names are stored without blanks: one that arrives with and without them is one country."""
    named = countries.withColumn("country_name", F.trim("country_name"))
    return conform.remap(named, "country_name", fixed.COUNTRY_ALIASES)


def missing_countries(names: DataFrame, countries: DataFrame) -> DataFrame:
    """Code-list names without a row in the country list."""
    named = names.where(~F.col("country_code").isin(fixed.CODES_WITHOUT_COUNTRY))
    return enrich.missing(named, countries, "country_name").select(
        F.trim("country_name").alias("country_name"), "country_code"
    )


def conform_laureates(laureates: DataFrame) -> DataFrame:
    roles = ["birth_country", "death_country", "organization_country"]
    rows = conform.remap(laureates, roles, fixed.LAUREATE_COUNTRY_ALIASES, trim=False)
    name, city = F.trim("organization_name"), F.trim("organization_city")
    rules = [
        ("organization_city", [(name == org, place) for org, place in fixed.ORGANIZATION_CITIES.items()]),
        (
            "organization_country",
            [
                ((name == org) if place is None else (name == org) & (city == place), country)
                for org, place, country in fixed.ORGANIZATION_COUNTRIES
            ],
        ),
    ]
    return conform.patch(rows, rules)


def conform_cities(cities: DataFrame) -> DataFrame:
    """Add the label by which the laureate list names a city."""
    in_state = F.col("country_code") == fixed.STATE_COUNTRY
    label = joined_when(in_state, ", ", ["accent_city_name", "city_region"], "accent_city_name")
    return cities.withColumn("city_label", label)
