"""A small hand-written world: sources of three loads as files and frames."""

from __future__ import annotations

import csv
import json
import os

COUNTRY_HEADER = [
    "Country", "Region", "Population", "Area (sq. mi.)", "Pop. Density (per sq. mi.)",
    "Coastline (coast/area ratio)", "Net migration", "Infant mortality (per 1000 births)", "GDP ($ per capita)",
    "Literacy (%)", "Phones (per 1000)", "Arable (%)", "Crops (%)", "Other (%)", "Climate", "Birthrate",
    "Deathrate", "Agriculture", "Industry", "Service",
]


def country(name, region, population, gdp="1000", climate="3"):
    return [
        name, region, str(population), "500", "12.5", "0.100", "1.5", "6.5", gdp, "97.0", "898.0", "19.1", "0.2",
        "80.7", climate, "14.1", "8.2", "0.01", "0.204", "0.787",
    ]


COUNTRIES = [
    country("United States ", "NORTHERN AMERICA", 298444215, "37800"),
    country("Germany ", "WESTERN EUROPE", 82422299, "27600"),
    country("Poland ", "EASTERN EUROPE", 38536869, "11100"),
    country("France ", "WESTERN EUROPE", 60876136, "27600"),
    country("Korea, South ", "ASIA (EX. NEAR EAST)", 48846823, "17800"),
    country("Russia ", "C.W. OF IND. STATES", 142893540, "8900"),
    country("Gaza Strip ", "NEAR EAST", 1428757, "600"),
    country("West Bank ", "NEAR EAST", 2460492, "800"),
    country("Netherlands Antilles ", "LATIN AMER. & CARIB", 221736, "11400"),
    country("Sweden ", "WESTERN EUROPE", 9016596, "26800", "not known"),
    country("Tunisia ", "NORTHERN AFRICA", 10175014, "6900"),
    country("United Kingdom ", "WESTERN EUROPE", 60609153, "27700"),
    country("Turkey ", "NEAR EAST", 70413958, "6700"),
]
COUNTRIES_2 = [*COUNTRIES, country("Italy ", "WESTERN EUROPE", 58133509, "26700")]

CODE_LISTS = {
    "country_names": {
        "US": "United States", "DE": "Germany", "PL": "Poland", "FR": "France", "KR": "South Korea", "RU": "Russia",
        "PS": "Palestinian Territory", "BQ": "Bonaire", "CW": "Curacao", "SX": "Sint Maarten", "SE": "Sweden",
        "TN": "Tunisia", "GB": "United Kingdom", "TR": "Turkey", "HK": "Hong Kong", "AQ": "Antarctica", "IT": "Italy",
    },
    "country_iso3": {"US": "USA", "DE": "DEU", "PL": "POL", "FR": "FRA", "SE": "SWE", "TR": "TUR", "HK": "HKG"},
    "country_currencies": {"US": "USD", "DE": "EUR", "FR": "EUR", "PL": "PLN", "SE": "SEK", "AQ": "", "GB": "GBP"},
    "country_continents": {
        "US": "NA", "DE": "EU", "PL": "EU", "FR": "EU", "KR": "AS", "RU": "EU", "PS": "AS", "SE": "EU", "TN": "AF",
        "GB": "EU", "TR": "AS", "HK": "AS", "AQ": "AN", "XX": "??",
    },
    "country_phones": {"US": "1", "DE": "49", "PL": "48", "TR": "90", "HK": "852"},
    "country_capital": {"US": "Washington", "DE": "Berlin", "PL": "Warsaw", "AQ": "", "HK": "Hong Kong", "SE": "Stockholm"},
}
FIELDS = {
    "country_names": "name", "country_iso3": "iso3", "country_currencies": "currency",
    "country_continents": "continent", "country_phones": "phone", "country_capital": "capital",
}


def city(code, name, region, population, latitude, longitude):
    return (code, name.lower(), name, region, population, latitude, longitude)


CITIES = [
    city("us", "Berkeley", "CA", 100000.0, 37.87, -122.27),
    city("us", "Durham", "NC", 200000.0, 36.0, -78.9),
    city("us", "Newark", "DE", 30000.0, 39.68, -75.75),
    city("us", "Murray Hill", "NJ", 3000.0, 40.7, -74.4),
    city("us", "Holmdel", "NJ", 2000.0, 40.3, -74.2),
    city("us", "Springfield", "IL", 110000.0, 39.8, -89.6),
    city("us", "Springfield", "MA", 150000.0, 42.1, -72.6),
    city("us", "Los Angeles", "CA", 3900000.0, 34.05, -118.2),
    city("de", "Munich", "02", 1260000.0, 48.1, 11.6),
    city("de", "Berlin", "16", 3400000.0, 52.5, 13.4),
    city("de", "Neustadt", "02", 5000.0, 49.6, 10.6),
    city("de", "Neustadt", "02", None, 50.3, 11.1),
    city("pl", "Neustadt", "79", 60000.0, 50.3, 17.6),
    city("pl", "Breslau", "72", 630000.0, 51.1, 17.0),
    city("pl", "Krakow", "77", 750000.0, 50.06, 19.9),
    city("ps", "Gaza", "GZ", 400000.0, 31.5, 34.45),
    city("ps", "Boundary", "GZ", 10.0, 31.4, 34.8),
    city("ps", "Hebron", "WE", 160000.0, 31.5, 35.1),
    city("ps", "Nowhere", "WE", 1.0, 31.0, None),
    city("an", "Kralendijk", "00", 3000.0, 12.15, -68.27),
    city("an", "Willemstad", "00", 125000.0, 12.1, -68.9),
    city("zr", "Duptown", "00", 1.0, 0.0, 0.0),
    city("fr", "Paris", "A8", 2100000.0, 48.86, 2.34),
    city("tn", "Tunis", "36", 700000.0, 36.8, 10.2),
    city("ru", "Leningrad", "66", 4000000.0, 59.9, 30.3),
    city("hk", "Hong Kong", "00", 7000000.0, 22.3, 114.2),
    city("qq", "Orphan", "00", 1.0, 1.0, 1.0),
]
# A changed population, a city gone from the list, a new city.
CITIES_2 = [
    city("de", "Berlin", "16", 3500000.0, 52.5, 13.4) if c[2] == "Berlin" else c for c in CITIES if c[2] != "Newark"
] + [city("it", "Rome", "07", 2500000.0, 41.9, 12.5)]
CITY_SCHEMA = (
    "country string, city string, accentcity string, region string, population double, latitude double, "
    "longitude double"
)

LAUREATE_HEADER = [
    "Year", "Category", "Prize", "Motivation", "Prize Share", "Laureate ID", "Laureate Type", "Full Name",
    "Birth Date", "Birth City", "Birth Country", "Sex", "Organization Name", "Organization City",
    "Organization Country", "Death Date", "Death City", "Death Country",
]


def person(number, year, category, name, born, city_, country_, org=("", "", ""), died=("", "", ""), sex="Male"):
    prize = f"Prize in {category} {year}"
    return [
        str(year), category, prize, f'"for work {number}, part 1"', "1/1", str(number), "Individual", name, born, city_,
        country_, sex, *org, *died,
    ]


US = "United States of America"
LAUREATES = [
    person(1, 1918, "Chemistry", "Via Parent", "1868-12-09", "Breslau", "Prussia (Poland)"),
    person(2, 1996, "Literature", "Via Override", "1923-07-02", "Kraków", "Poland", sex="Female"),
    ["1917", "Peace", "Prize in Peace 1917", "", "1/1", "3", "Organization", "Red Cross", *[""] * 10],
    person(4, 1950, "Peace", "No Organization", "1904-08-07", "Munich ", "Germany"),
    person(5, 1951, "Physics", "Two Places", "1905-01-01", "Berlin", "Germany", ("A Institute", "Munich", "Germany")),
    person(5, 1951, "Physics", "Two Places", "1905-01-01", "Berlin", "Germany", ("C Institute", "Paris", "France")),
    person(6, 1952, "Physics", "Three Places", "1906-01-01", "Paris", "France", ("C Institute", "Paris", "France")),
    person(6, 1952, "Physics", "Three Places", "1906-01-01", "Paris", "France", ("A Institute", "Munich", "Germany")),
    person(6, 1952, "Physics", "Three Places", "1906-01-01", "Paris", "France", ("B Institute", "Tunis", "Tunisia")),
    *[
        person(7, 1953, "Physics", "Four Places", "1907-01-01", "Paris", "France", (f"{x} Institute", place, land))
        for x, place, land in (
            ("D", "Munich", "Germany"), ("A", "Munich", "Germany"), ("C", "Paris", "France"), ("B", "Tunis", "Tunisia"),
        )
    ],
    person(8, 1903, "Physics", "Two Prizes", "1867-11-07", "Paris", "France", sex="Female"),
    person(8, 1911, "Chemistry", "Two Prizes", "1867-11-07", "Paris", "France", sex="Female"),
    person(9, 1960, "Physics", "Holmdel Person", "1920-01-01", "Springfield, MA", US, ("Bell Laboratories", "Holmdel, NJ", US)),
    person(10, 1961, "Physics", "Murray Person", "1921-01-01", "Springfield, IL", US, ("Bell Laboratories", "Murray Hill, NJ", US)),
    person(11, 1962, "Medicine", "Duke Person", "1922-01-01", "Durham, NC", US, ("Duke University Medical Center", "Durham, NC", US)),
    person(12, 1963, "Medicine", "Never Found", "1923-01-01", "Atlantis", "Nowhereland", died=("1990-05-05", "Munich", "Germany")),
    person(14, 1965, "Medicine", "Homonym", "1925-01-01", "Neustadt", "Germany", died=("1991-05-05", "Neustadt", "Poland")),
    person(15, 1966, "Medicine", "Patched", "1926-01-01", "Berlin", "Germany (Poland)", ("Howard Hughes Medical Institute", "", "")),
    person(16, 1928, "Medicine", "Tunis Person", "1866-09-21", "Paris", "France", ("Institut Pasteur", "Tunis", "France")),
    person(17, 1970, "Literature", "Soviet Person", "1918-12-11", "Leningrad", "Union of Soviet Socialist Republics"),
    person(18, 1971, "Literature", "Bad Date", "1918-00-00", "Seoul", "South Korea"),
    person(19, 1972, "Chemistry", "Angeles Person", "1930-01-01", "Los Angeles, CA", US, ("University of California", "Los Angeles, CA", US)),
    person(20, 1973, "Peace", "Hong Kong Person", "1931-01-01", "Hong Kong", "Hong Kong"),
]
# A known organization again, one more place for a known prize, a known society with a new prize.
LAUREATES_2 = [
    person(21, 2001, "Physics", "New Person", "1960-01-01", "Rome", "Italy", ("A Institute", "Munich", "Germany")),
    person(5, 1951, "Physics", "Two Places", "1905-01-01", "Berlin", "Germany", ("B Institute", "Tunis", "Tunisia")),
    ["1944", "Peace", "Prize in Peace 1944", "", "1/1", "3", "Organization", "Red Cross", *[""] * 10],
]


def write_csv(folder: str, header: list[str], rows: list[list[str]]) -> str:
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "part.csv"), "w", newline="", encoding="utf8") as f:
        # Quotes inside values are escaped with a backslash.
        writer = csv.writer(f, quoting=csv.QUOTE_ALL, doublequote=False, escapechar="\\")
        writer.writerow(header)
        writer.writerows(rows)
    return folder


def write_json(folder: str, name: str) -> str:
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "part.json"), "w", encoding="utf8") as f:
        for code, value in CODE_LISTS[name].items():
            f.write(json.dumps({"country": code, FIELDS[name]: value}) + "\n")
    return folder
