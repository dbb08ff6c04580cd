"""The wide table: one row per laureate and prize, with three organizations side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowloom.functions import null_safe_equal
from snowloom.operators import conform, enrich, reshape, versioning
from snowloom.operators.enrich import Step
from snowloom.operators.reshape import KEY
from snowloom.plans.laureates import ORGANIZATION_KEY
from snowloom.session import materialize

DATASET_KEY = ["laureate_id", "prize"]
SLOTS = 3

# Country attributes each role shows: attribute of the country, name after the role.
_PLACE = {"region_name": "region_name", "continent_name": "continent_name"}
_BIRTH = _PLACE | {
    "population": "country_population",
    "area_sq_miles": "country_area_sq_miles",
    "pop_dencity_per_sq_mile": "country_pop_dencity_per_sq_mile",
    "coastline": "country_coastline",
    "net_migration": "country_net_migration",
    "infant_mortality_per_1000": "country_infant_mortality_per_1000",
    "gdb_dollar_per_capita": "country_gdb",
    "percent_literacy": "country_percent_literacy",
    "phones_per_1000": "country_phones_per_1000",
    "percent_arable": "country_percent_arable",
    "percent_crops": "country_percent_crops",
    "percent_other": "country_percent_other",
    "climate": "country_climate",
    "birthrate": "country_birthrate",
    "deathrate": "country_deathrate",
    "agriculture": "country_agriculture",
    "industry": "country_industry",
    "service": "country_service",
}
_DEATH = _PLACE | {
    "population": "country_population",
    "gdb_dollar_per_capita": "country_gdb",
    "coastline": "country_coastline",
    "climate": "country_climate",
}
_ORGANIZATION = _PLACE | {"population": "country_population", "gdb_dollar_per_capita": "country_gdb"}
_CITY = {
    "city_region": "city_region",
    "population": "city_population",
    "latitude": "city_latitude",
    "longitude": "city_longitude",
}
_SLOT = [
    "organization_name", "organization_parent_name", "organization_city_name", "organization_city_region",
    "organization_city_population", "organization_city_latitude", "organization_city_longitude",
    "organization_country_name", "organization_country_parent_name", "organization_region_name",
    "organization_continent_name", "organization_country_population", "organization_country_gdb",
]


def _role_columns(role: str, attributes: dict[str, str]) -> list[str]:
    city = [f"{role}_city_name", *[f"{role}_{name}" for name in _CITY.values()]]
    country = [f"{role}_country_name", f"{role}_country_parent_name"]
    return [*city, *country, *[f"{role}_{name}" for name in attributes.values()]]


COLUMNS = [
    "laureate_id", "prize", "prize_share", "laureate_type", "motivation", "laureate_person_name", "laureate_gender",
    "society_name", "birth_date", *_role_columns("birth", _BIRTH), "death_date", *_role_columns("death", _DEATH),
    *[f"{c}{i}" for i in range(1, SLOTS + 1) for c in _SLOT],
    "year", "category", "upd_date",
]


def country_places(countries: DataFrame, regions: DataFrame, continents: DataFrame) -> DataFrame:
    """Per country id its parent's name and the attributes of the country of today, all joined once."""
    described = enrich.lookup_chain(
        countries, [Step(regions, "region_id", ["region_name"]), Step(continents, "continent_id", ["continent_name"])]
    )
    today = countries.select("country_id", F.coalesce("parent_country_id", "country_id").alias("today_id"), "parent_country_id")
    named = enrich.lookup(today, countries, {"parent_country_id": "country_id"}, {"country_name": "parent_country_name"})
    return enrich.lookup(named, described, {"today_id": "country_id"}, list(_BIRTH)).drop("today_id")


def organization_roles(
    places: DataFrame, organizations: DataFrame, countries: DataFrame, cities: DataFrame
) -> DataFrame:
    """Per organization its parent's name and the attributes of its country and city."""
    rows = enrich.lookup(
        places, organizations, "organization_id",
        ["organization_country_id", "organization_city_id", "parent_organization_id"],
    )
    rows = enrich.with_parent(
        rows, "organization_id", "parent_organization_id", {"organization_name": "organization_parent_name"}
    )
    rows = enrich.role_lookup(rows, cities, "organization_city_id", "city_id", "organization_", _CITY)
    attributes = _ORGANIZATION | {"parent_country_name": "country_parent_name"}
    return enrich.role_lookup(rows, countries, "organization_country_id", "country_id", "organization_", attributes)


def dataset(
    laureates: DataFrame,
    persons: DataFrame,
    places: DataFrame,
    organizations: DataFrame,
    countries: DataFrame,
    cities: DataFrame,
    regions: DataFrame,
    continents: DataFrame,
    keys_: Sequence[str] = DATASET_KEY,
) -> DataFrame:
    """Flatten the snowflake. Laureate rows are reduced to one per key before anything is joined.

    That gives what joining first and collapsing afterwards would give, because all joined attributes
    hang on the laureate or on the organization of a slot; but the joins see far fewer rows.
    """
    keys_ = list(keys_)
    rows = conform.split_by_type(
        laureates, "laureate_type", "full_name", {"Individual": "laureate_person_name", "Organization": "society_name"}
    )
    rows = conform.rename(
        rows,
        {"gender": "laureate_gender"}
        | {f"{role}_{kind}": f"{role}_{kind}_name" for role in ("birth", "death") for kind in ("city", "country")},
    )
    own = [
        "laureate_id", "prize", "year", "category", "prize_share", "laureate_type", "motivation",
        "laureate_person_name", "laureate_gender", "society_name", "birth_date", "birth_city_name",
        "birth_country_name", "death_date", "death_city_name", "death_country_name",
    ]
    rows = reshape.as_one_key(rows, keys_)
    whole = reshape.collapse(rows, [KEY], [c for c in own if c not in keys_], ["upd_date"])

    worked = rows.where(F.col("organization_name").isNotNull())
    worked = worked.select(KEY, *[F.trim(c).alias(c) for c in ORGANIZATION_KEY]).distinct()
    first = reshape.first_rows(
        worked, [KEY], ["organization_name", "organization_city", "organization_country"], SLOTS, "__slot"
    )
    # Written once: they are used several times, and Spark then knows their size when it picks the joins.
    geography = materialize(country_places(countries, regions, continents), "country-places")
    roles = materialize(organization_roles(places, organizations, geography, cities), "organization-roles")
    roles = roles.select(
        "organization_id", *[F.col(c).alias(f"__{c}") for c in ORGANIZATION_KEY], *[c for c in _SLOT if c not in (
            "organization_name", "organization_city_name", "organization_country_name")],
    )
    first = first.join(roles, null_safe_equal([(c, f"__{c}") for c in ORGANIZATION_KEY]), "left")
    first = conform.rename(
        first, {"organization_city": "organization_city_name", "organization_country": "organization_country_name"}
    )
    first = first.withColumn(
        "organization_country_parent_name", F.coalesce("organization_country_parent_name", "organization_country_name")
    )
    slotted = reshape.pivot_slots(first, [KEY], "__slot", _SLOT, SLOTS)

    newest = versioning.latest(persons, ["laureate_id"], "upd_date", "one", ["full_name", "birth_date"])
    ids = ["birth_city_id", "birth_country_id", "death_city_id", "death_country_id"]
    wide = whole.join(slotted, KEY, "left").withColumn("__laureate", F.col(f"{KEY}.laureate_id"))
    wide = enrich.lookup(wide, newest, {"__laureate": "laureate_id"}, ids)
    for role, attributes in (("birth", _BIRTH), ("death", _DEATH)):
        wide = enrich.role_lookup(wide, cities, f"{role}_city_id", "city_id", f"{role}_", _CITY)
        wide = enrich.role_lookup(
            wide, geography, f"{role}_country_id", "country_id", f"{role}_",
            attributes | {"parent_country_name": "country_parent_name"},
        )
        parent = f"{role}_country_parent_name"
        wide = wide.withColumn(parent, F.coalesce(parent, f"{role}_country_name"))
    return reshape.split_key(wide, keys_).select(*COLUMNS)
