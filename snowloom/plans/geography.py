"""Countries, their codes, and cities."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snowloom.functions import null_safe_equal, row_hash
from snowloom.operators import conform, enrich, keys, versioning
from snowloom.operators.enrich import ParentRule, Step
from snowloom.operators.versioning import union_all
from snowloom.plans import fixed_values as fixed
from snowloom.plans import schemas
from snowloom.session import materialize
from snowloom.sinks import stamp

# What makes a city one city over all snapshots, and what tells two of one snapshot apart.
CITY_KEY = ["country_id", "city_region", "accent_city_name"]
CITY_ROW = [*CITY_KEY, "latitude", "longitude"]

COUNTRY_RULES = [ParentRule({"country_name": names}, {"country_name": parent}) for names, parent in fixed.COUNTRY_PARENTS]


def countries(
    conformed: DataFrame,
    missing: DataFrame,
    historical: DataFrame,
    regions: DataFrame,
    continents: DataFrame,
    names: DataFrame,
    continent_list: DataFrame,
    capital_list: DataFrame,
    batch_date: date | str,
    prev: DataFrame | None,
    rules: Sequence[ParentRule] = COUNTRY_RULES,
) -> DataFrame:
    """One snapshot of all countries: listed, missing from the list, and historical with their parent.

    ``prev`` has the names known so far; they keep their ids.
    """
    today = union_all([conformed, stamp(missing.select("country_name"), batch_date)])
    held = None if prev is None else prev.select("country_id", "country_name").distinct()
    ids = keys.stable_ids(today.select("country_name").distinct(), held, ["country_name"], "country_id")
    past = stamp(enrich.missing(historical.select("country_name"), today, "country_name"), batch_date)
    held = ids if held is None else held.unionByName(ids).distinct()
    past = keys.stable_ids(past, held, ["country_name"], "country_id")
    past = enrich.resolve_parent(past, rules, ids, "country_id", "parent_country_id")
    rows = union_all([keys.attach_ids(today, ids, ["country_name"], "country_id"), past])

    steps = [
        Step(continent_list, "country_code", ["continent_code"]),
        Step(continents, "continent_code", ["continent_id"]),
        Step(capital_list, "country_code", ["capital_name"]),
    ]
    by_name = enrich.lookup_chain(names.select("country_code", F.col("country_name").alias("listed_name")), steps)
    rows = enrich.lookup_chain(
        rows,
        [
            Step(regions, {"region": "region_name"}, ["region_id"]),
            Step(by_name, {"country_name": "listed_name"}, ["continent_id", "capital_name"]),
        ],
    )
    rows = conform.override(rows, "country_name", "capital_name", fixed.CAPITAL_OVERRIDES, empty_is_null=True)
    forced = F.lit(None).cast("long")
    for name in sorted(set(fixed.CONTINENT_OVERRIDES.values())):
        members = [c for c, continent in fixed.CONTINENT_OVERRIDES.items() if continent == name]
        its_id = continents.where(F.col("continent_name") == name).agg(F.max("continent_id")).scalar()
        forced = F.when(F.trim("country_name").isin(members), its_id).otherwise(forced)
    listed = F.trim("country_name").isin(list(fixed.CONTINENT_OVERRIDES))
    rows = rows.withColumn("continent_id", F.when(listed, forced).otherwise(F.col("continent_id")))
    return rows.select(
        "country_id", "country_name", "region_id", "continent_id", "parent_country_id", "capital_name",
        *schemas.COUNTRY_MEASURES, "upd_date",
    )


def country_codes(
    names: DataFrame,
    iso3: DataFrame,
    currency_list: DataFrame,
    phones: DataFrame,
    currencies: DataFrame,
    prev: DataFrame | None = None,
) -> DataFrame:
    """All code systems of each code-list name. Every list is joined on the code of the name itself.

    A name and code known in ``prev`` keep their id, however the list has grown since.
    """
    steps = [
        Step(iso3, "country_code", ["iso3_code"]),
        Step(currency_list, "country_code", ["currency_code"]),
        Step(currencies, "currency_code", ["currency_code_id"]),
        Step(phones, "country_code", ["phone_code"]),
    ]
    rows = enrich.lookup_chain(names.select("country_code", F.col("country_name").alias("code_name")), steps)
    rows = rows.withColumnRenamed("country_code", "iso2_code")
    return keys.stable_ids(rows, prev, ["code_name", "iso2_code"], "country_code_id").select(
        "country_code_id", "code_name", "iso2_code", "iso3_code", "currency_code_id", "phone_code"
    )


def codes_in_countries(codes: DataFrame, countries: DataFrame) -> DataFrame:
    """Which code belongs to which country, with names; the bridge is its id columns.

    Some countries share a code and some codes share a country; those pairs are stated, all others
    are matched by name.
    """
    of_today = countries.where("parent_country_id is null")
    pairs = enrich.outer_match(
        codes, of_today, {"code_name": "country_name"}, ["iso2_code"], ["country_name"]
    )
    forced = conform.override(pairs, "country_name", "iso2_code", fixed.FORCED_CODES)
    by_code = F.try_element_at(
        F.create_map(*[F.lit(x) for pair in fixed.FORCED_COUNTRIES.items() for x in pair]), F.trim("iso2_code")
    )
    named = forced.withColumn("country_name", F.coalesce(by_code, "country_name"))
    kept = named.where("iso2_code is not null and country_name is not null").distinct()
    found = enrich.lookup(kept, codes, "iso2_code", ["country_code_id"], how="inner")
    found = enrich.lookup(found, countries, "country_name", ["country_id"], how="inner")
    return keys.dense_id(found, ["country_code_id", "country_id"], "code_in_country_id")


def city_codes(pairs: DataFrame) -> DataFrame:
    """Country codes as the city list writes them, and the country of each."""
    codes = pairs.select(F.lower("iso2_code").alias("iso2_code"), "country_name", "country_id")
    merged = conform.merge_codes(codes, "iso2_code", fixed.MERGED_CITY_CODES)
    return conform.override(merged, "country_name", "iso2_code", fixed.SPLIT_NAMES)


def cities(conformed: DataFrame, pairs: DataFrame, prev: DataFrame | None) -> DataFrame:
    """Cities of a snapshot with their country and a stable id, still with label and country code."""
    rows = conformed.where(F.col("country_code") != fixed.DUPLICATE_CITY_CODE)
    rows = conform.threshold_split(
        rows, "country_code", fixed.SPLIT_CITY_CODE, "longitude", fixed.SPLIT_LONGITUDE, fixed.SPLIT_WEST,
        fixed.SPLIT_EAST, out="place_code",
    )
    rows = enrich.lookup(rows, city_codes(pairs), {"place_code": "iso2_code"}, ["country_id"]).drop("place_code")
    ids = city_ids(rows, prev)
    return ids.select(
        "city_id", "city_name", "accent_city_name", "country_id", "city_region", "population", "latitude",
        "longitude", "city_label", "country_code", "upd_date",
    )


def city_ids(rows: DataFrame, prev: DataFrame | None) -> DataFrame:
    """Give every city of one list the id it had, else the next free one.

    A city is known by country, region and name. Where a list has several of one key, those at coordinates
    known before keep the ids they had there; the rest take the key's other ids in order of their coordinates.
    So a corrected coordinate changes no id. Rows that agree in all of this are told apart by population.
    """
    order = ["country_id", "accent_city_name", "city_region", "latitude", "longitude", "__same"]
    same = W.partitionBy(*CITY_ROW).orderBy(F.col("population").desc_nulls_last(), row_hash(rows))
    rows = materialize(rows.withColumn("__same", F.row_number().over(same)), "city-rows")
    if prev is None:
        return keys.dense_id(rows, order, "city_id")
    # The places at which each id was last seen, told apart as in a list.
    last = versioning.latest(prev.select(*CITY_ROW, "city_id", "upd_date"), ["city_id"], "upd_date")
    last = last.withColumn("__same", F.row_number().over(W.partitionBy(*CITY_ROW).orderBy("city_id")))
    last = materialize(last, "city-ids")
    there = last.select("city_id", *[F.col(c).alias(f"__k{i}") for i, c in enumerate([*CITY_ROW, "__same"])])
    exact = rows.join(there, null_safe_equal([(c, f"__k{i}") for i, c in enumerate([*CITY_ROW, "__same"])]), "left")
    exact = materialize(exact.select("city_id", *rows.columns), "city-matches")

    def ranked(frame: DataFrame, *by) -> DataFrame:
        return frame.withColumn("__rank", F.row_number().over(W.partitionBy(*CITY_KEY).orderBy(*by)))

    moved = ranked(exact.where("city_id is null").drop("city_id"), "latitude", "longitude", "__same")
    taken = exact.where("city_id is not null").select(F.col("city_id").alias("__taken"))
    free = ranked(last.join(taken, F.col("city_id") == F.col("__taken"), "left_anti"), F.col("upd_date").desc(), "city_id")
    free = free.select("city_id", *[F.col(c).alias(f"__k{i}") for i, c in enumerate([*CITY_KEY, "__rank"])])
    found = moved.join(free, null_safe_equal([(c, f"__k{i}") for i, c in enumerate([*CITY_KEY, "__rank"])]), "left")
    found = materialize(found.select("city_id", *rows.columns), "city-moves")
    new = keys.dense_id(found.where("city_id is null").drop("city_id"), order, "city_id", keys.next_id(prev, "city_id"))
    return versioning.union_all([f.where("city_id is not null") for f in (exact, found)] + [new])


def city_overrides(seeds: DataFrame, cities: DataFrame) -> DataFrame:
    """The city that stands for each name the city list does not have."""
    on = {"orig_city_name": "accent_city_name", "orig_region": "city_region", "orig_country": "country_code"}
    return enrich.lookup(seeds, cities, on, ["city_id"], lowest=True)


