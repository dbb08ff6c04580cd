"""Societies, persons, organizations, their bridge, and the prizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowloom.operators import enrich, keys, reshape, versioning
from snowloom.operators.enrich import Candidate, ParentRule
from snowloom.plans import fixed_values as fixed
from snowloom.session import materialize

PERSON = "laureate_type = 'Individual'"
SOCIETY = "laureate_type = 'Organization'"
WORKING_PERSON = f"{PERSON} AND organization_name IS NOT NULL"

ORGANIZATION_KEY = ["organization_name", "organization_country", "organization_city"]
PERSON_KEY = ["full_name", "birth_date"]
PRIZE_KEY = ["laureate_id", "prize_type_id"]
PRIZE_COLUMNS = ["laureate_id", "year", "motivation", "prize_share", "category", "laureate_type", "prize", "upd_date"]


def _organization_rules() -> list[ParentRule]:
    rules = []
    for names, city, elsewhere, country, parent_name, parent_city, parent_country in fixed.ORGANIZATION_PARENTS:
        when, unless = {"organization_name": names}, {}
        if city is not None:
            (unless if elsewhere else when)["organization_city"] = [city]
        if country is not None:
            when["organization_country"] = [country]
        parent = {
            "organization_name": parent_name,
            "organization_city": parent_city,
            "organization_country": parent_country,
        }
        rules.append(ParentRule(when, {c: v for c, v in parent.items() if v is not None}, unless))
    return rules


ORGANIZATION_RULES = _organization_rules()


def societies(laureates: DataFrame, prev: DataFrame | None) -> DataFrame:
    cols = {"laureate_id": "laureate_id", "full_name": "society_name", "upd_date": "upd_date"}
    new = reshape.entity(laureates, cols, SOCIETY)
    return versioning.upsert_latest(prev, new, ["society_name"], "upd_date", ["laureate_id"])


def _with_country(df: DataFrame, role: str, countries: DataFrame) -> DataFrame:
    taken = {"country_id": f"{role}_country_id", "parent_country_id": f"{role}_parent_id"}
    return enrich.lookup(df, countries, {f"{role}_country": "country_name"}, taken)


def _with_city(df: DataFrame, role: str, cities: DataFrame, overrides: DataFrame) -> DataFrame:
    """The city by its country, else by the country's parent, else by the list of overrides."""
    city = f"{role}_city"
    ways = [
        Candidate(cities, {city: "city_label", f"{role}_country_id": "country_id"}, "city_id"),
        Candidate(cities, {city: "city_label", f"{role}_parent_id": "country_id"}, "city_id"),
        Candidate(overrides, {city: "mis_city_name"}, "city_id"),
    ]
    return enrich.first_match(df, ways, f"{role}_city_id")


def persons(
    laureates: DataFrame,
    genders: DataFrame,
    countries: DataFrame,
    cities: DataFrame,
    overrides: DataFrame,
    prev: DataFrame | None,
) -> DataFrame:
    """Laureates who are persons, with the ids of their places, the newest row of each."""
    cols = [
        "laureate_id", "full_name", "gender", "birth_date", "birth_city", "birth_country", "death_date", "death_city",
        "death_country", "upd_date",
    ]
    # Reduced to one row per person before the places are looked up, so each person is looked up once.
    new = versioning.latest(reshape.entity(laureates, cols, PERSON), PERSON_KEY, "upd_date", "one", ["laureate_id"])
    # Written once: the places of each role are resolved from it before it is itself read.
    new = materialize(enrich.lookup(new, genders, "gender", ["gender_id"]), "persons")
    for role in ("birth", "death"):
        new = _with_city(_with_country(new, role, countries), role, cities, overrides)
    new = new.select(
        "laureate_id", "full_name", "gender_id", "birth_date", "birth_city_id", "birth_country_id", "death_date",
        "death_city_id", "death_country_id", "upd_date",
    )
    if prev is None:
        return new
    return versioning.upsert_latest(prev, new, PERSON_KEY, "upd_date", ["laureate_id"])


def organization_places(laureates: DataFrame, seeds: DataFrame, prev: DataFrame | None) -> DataFrame:
    """Organizations by name, country and city, with stable ids and the newest load date.

    An organization in two cities is two organizations: rules tell them apart by city. ``seeds`` are
    parents nobody worked at; one that is known already is not added again.
    """
    named = laureates.where(WORKING_PERSON)
    new = named.select(*[F.trim(c).alias(c) for c in ORGANIZATION_KEY], "upd_date")
    frames = [new] if prev is None else [prev.select(*ORGANIZATION_KEY, "upd_date"), new]
    rows = versioning.union_all(frames).groupBy(*ORGANIZATION_KEY).agg(F.max("upd_date").alias("upd_date"))
    ids = keys.stable_ids(rows, prev, ORGANIZATION_KEY, "organization_id")
    added = versioning.append_guarded(ids, seeds.select(*ORGANIZATION_KEY, "upd_date"), ORGANIZATION_KEY)
    added = keys.dense_id(added, ORGANIZATION_KEY, "organization_id", keys.next_id(ids, "organization_id"))
    return ids.unionByName(added).select("organization_id", *ORGANIZATION_KEY, "upd_date")


def organizations(
    places: DataFrame,
    countries: DataFrame,
    cities: DataFrame,
    overrides: DataFrame,
    rules: Sequence[ParentRule] = ORGANIZATION_RULES,
) -> DataFrame:
    """Organizations with their parent and the ids of their place."""
    rows = enrich.resolve_parent(places, rules, places, "organization_id", "parent_organization_id")
    rows = _with_city(_with_country(rows, "organization", countries), "organization", cities, overrides)
    return rows.select(
        "organization_id", "organization_name", "organization_country_id", "organization_city_id",
        "parent_organization_id", "upd_date",
    )


def persons_in_orgs(laureates: DataFrame, places: DataFrame, prev: DataFrame | None) -> DataFrame:
    """Which person worked at which organization."""
    cols = ["laureate_id", *ORGANIZATION_KEY, "upd_date"]
    rows = reshape.entity(laureates, cols, WORKING_PERSON)
    rows = enrich.lookup(rows, places, ORGANIZATION_KEY, ["organization_id"], how="inner")
    pair = ["laureate_id", "organization_id"]
    frames = [rows.select(*pair, "upd_date")]
    if prev is not None:
        frames.append(prev.select(*pair, "upd_date"))
    newest = versioning.union_all(frames).groupBy(*pair).agg(F.max("upd_date").alias("upd_date"))
    return keys.stable_ids(newest, prev, pair, "per_org_id").select("per_org_id", *pair, "upd_date")


def nobel_prizes(
    laureates: DataFrame,
    categories: DataFrame,
    prize_types: DataFrame,
    laureate_types: DataFrame,
    prev: DataFrame | None,
) -> DataFrame:
    """The new prizes, numbered on from those before. A prize already stored is not stored again."""
    rows = reshape.entity(laureates, PRIZE_COLUMNS)
    rows = enrich.lookup(rows, categories, "category", ["category_id"])
    rows = enrich.lookup(rows, prize_types, {"prize": "prize_type"}, ["prize_type_id"])
    rows = enrich.lookup(rows, laureate_types, "laureate_type", ["laureate_type_id"])
    # A prize that several pending batches bring is one fact, as it would be over several runs: the newest.
    rows = versioning.latest(rows, PRIZE_KEY, "upd_date", "one")
    rows = versioning.append_guarded(prev, rows, PRIZE_KEY)
    start = 0 if prev is None else keys.next_id(prev, "nobel_prize_id")
    return keys.dense_id(rows, ["year", "laureate_id"], "nobel_prize_id", start).select(
        "nobel_prize_id", "year", "laureate_id", "laureate_type_id", "prize_type_id", "prize_share", "motivation",
        "category_id", "upd_date",
    )
