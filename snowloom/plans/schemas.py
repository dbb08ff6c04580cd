"""Columns of the sources, their canonical names, and the layouts of the warehouse tables.

Fixed values: names, types, lengths, partition columns and numbers of buckets are those of the sources and of
the warehouse, and must stay as they are.
"""

from __future__ import annotations

from snowloom.sinks import Layout

LAUREATE_FILE = (
    "year int, category string, prize string, motivation string, prize_share string, laureate_id int, "
    "laureate_type string, full_name string, birth_date date, birth_city string, birth_country string, "
    "gender string, organization_name string, organization_city string, organization_country string, "
    "death_date date, death_city string, death_country string"
)

# Further names of columns in laureate files.
LAUREATE_SPELLINGS = {"gender": ["Sex"]}

COUNTRY_FILE = (
    "country string, region string, population int, area_sq_mi int, pop_density_per_sq_mi decimal(8,2), "
    "coastline decimal(7,3), net_migration decimal(6,3), infant_mortality_per_1000_births decimal(7,3), "
    "gdp_dol_per_capita int, literacy_percent decimal(6,3), phones_per_1000 decimal(7,3), "
    "arable_percent decimal(6,3), crops_percent decimal(6,3), other_percent decimal(6,3), climate decimal(4,2), "
    "birthrate decimal(6,3), deathrate decimal(6,3), agriculture decimal(5,4), industry decimal(5,4), "
    "service decimal(5,4)"
)

# Names in the country file that differ from those of the warehouse.
COUNTRY_NAMES = {
    "country": "country_name",
    "area_sq_mi": "area_sq_miles",
    "pop_density_per_sq_mi": "pop_dencity_per_sq_mile",
    "infant_mortality_per_1000_births": "infant_mortality_per_1000",
    "gdp_dol_per_capita": "gdb_dollar_per_capita",
    "literacy_percent": "percent_literacy",
    "arable_percent": "percent_arable",
    "crops_percent": "percent_crops",
    "other_percent": "percent_other",
}

# The city table of the database and the types its columns get.
CITY_NAMES = {
    "country": "country_code",
    "city": "city_name",
    "accentcity": "accent_city_name",
    "region": "city_region",
}
CITY_TYPES = (
    "city_name string, accent_city_name string, city_region string, population int, latitude decimal(20,17), "
    "longitude decimal(20,17), country_code string"
)

# Code lists: table name, field in the file, canonical column.
CODE_LISTS = {
    "country_names": ("name", "country_name"),
    "country_iso3": ("iso3", "iso3_code"),
    "country_currencies": ("currency", "currency_code"),
    "country_continents": ("continent", "continent_code"),
    "country_phones": ("phone", "phone_code"),
    "country_capital": ("capital", "capital_name"),
}

COUNTRY_MEASURES = [
    "population", "area_sq_miles", "pop_dencity_per_sq_mile", "coastline", "net_migration",
    "infant_mortality_per_1000", "gdb_dollar_per_capita", "percent_literacy", "phones_per_1000", "percent_arable",
    "percent_crops", "percent_other", "climate", "birthrate", "deathrate", "agriculture", "industry", "service",
]

# Declared lengths of texts, for the audit of incoming files.
LAUREATE_LENGTHS = {
    "category": 20, "prize": 50, "motivation": 255, "prize_share": 10, "laureate_type": 20, "full_name": 255,
    "birth_city": 50, "birth_country": 50, "gender": 10, "organization_name": 255, "organization_city": 50,
    "organization_country": 50, "death_city": 50, "death_country": 50,
}
COUNTRY_LENGTHS = {"country": 50, "region": 50}

STAGING_LAYOUTS = {
    "laureates": Layout(("upd_date",), 16, ("laureate_id",)),
    "countries": Layout(("upd_date",)),
    "cities": Layout(("upd_date",), 16, ("city_region", "accent_city_name")),
}

LAYOUTS = {
    "cities": Layout(("country_id", "upd_date"), 16, ("city_region", "city_id")),
    "countries": Layout(("upd_date",)),
    "dataset": Layout(("year", "category", "upd_date"), 32, ("laureate_id",)),
    "laureate_persons": Layout(("upd_date",), 32, ("laureate_id",)),
    "nobel_prizes": Layout(("category_id", "upd_date"), 16, ("laureate_id",)),
    "organizations": Layout(("upd_date",), 4, ("organization_id",)),
    "persons_in_orgs": Layout(("upd_date",), 16, ("laureate_id",)),
    "prize_types": Layout(("upd_date",)),
    "societies": Layout(("upd_date",), 8, ("laureate_id",)),
    "cities_labelled": Layout(("upd_date",)),
    "organization_places": Layout(),
}

PLAIN_TABLES = [
    "continents", "regions", "country_codes", "currencies", "codes_in_countries", "categories", "genders",
    "laureate_types",
]
