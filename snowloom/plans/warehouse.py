"""One run of the warehouse: read the new batches, bring every table up to date, note them as consumed.

The first load and every later one take the same path; the first merely finds no tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snowloom import sinks, sources
from snowloom.operators import quality, versioning
from snowloom.plans import conforming, geography, laureates, reference, schemas
from snowloom.plans import dataset as wide
from snowloom.plans import fixed_values as fixed
from snowloom.session import materialize, scratch_scope, tune
from snowloom.sinks import Layout, stamp


# The landings consumed so far.
MARKS = "consumed_batches"


class Run:
    """The tables of one target database during a run: as its last commit has them, and with what the run has changed.

    Nothing a run writes is seen by others before ``commit``, and then all of it is.
    """

    def __init__(self, spark: SparkSession, staging: str, target: str, batch_date: date | str):
        self.spark, self.staging, self.target, self.batch_date = spark, staging, target, batch_date
        self.tables = sinks.Commit(spark, target)
        # The batches of each source that this run reads, fixed before it reads any.
        self.pinned: dict[str, DataFrame] = {}

    def name(self, table: str) -> str:
        return f"{self.target}.{table}"

    def stored(self, table: str) -> DataFrame | None:
        return self.tables.frame(table)

    def __getitem__(self, table: str) -> DataFrame:
        found = self.tables.frame(table)
        if found is None:
            raise LookupError(f"{self.name(table)} has not been loaded")
        return found

    def publish(self, table: str, df: DataFrame) -> DataFrame:
        """Replace a table that the new content may have been computed from."""
        self.tables.publish(table, df, schemas.LAYOUTS.get(table, Layout()))
        return self[table]

    def put(self, table: str, df: DataFrame, day: date) -> DataFrame:
        """The batch of a day in a history, in place of what that day had there; returns the day's rows."""
        self.tables.put(table, df, "upd_date", day, schemas.LAYOUTS[table])
        return self[table].where(F.col("upd_date") == day)

    def merge(self, table: str, batch: DataFrame, keys: Sequence[str], **options) -> DataFrame:
        """Bring a current table up to date with a batch; see ``sinks.merge``."""
        self.tables.merge(table, batch, keys, "upd_date", layout=schemas.LAYOUTS.get(table, Layout()), **options)
        return self[table]

    def add(self, table: str, df: DataFrame) -> DataFrame:
        """Further rows of a table that has none of them."""
        self.tables.add(table, df, "upd_date", schemas.LAYOUTS[table])
        return self[table]

    def view(self, table: str, columns: Sequence[str], of: str) -> None:
        """Some columns of a table under a name of their own."""
        self.tables.view(table, columns, of)

    def consumed(self, table: str) -> DataFrame | None:
        """The landings of a source that runs have consumed."""
        marks = self.stored(MARKS)
        return None if marks is None else marks.where(F.col("source") == f"{self.staging}.{table}")

    def pin(self, table: str) -> DataFrame:
        """Fix the landings of a source that this run reads: those nobody has consumed."""
        self.pinned[table] = sinks.unconsumed(self.spark, f"{self.staging}.{table}", self.consumed(table))
        return self.pinned[table]

    def mark_consumed(self, table: str) -> None:
        """Note the pinned landings as consumed, in the same commit as what was made of them."""
        marks = self.pinned[table].select(F.lit(f"{self.staging}.{table}").alias("source"), "upd_date", "landing")
        self.tables.add(MARKS, marks, "upd_date")

    def listed(self, table: str) -> DataFrame:
        return self.spark.table(f"{self.staging}.{table}")

    def pending(self, table: str) -> DataFrame:
        """The rows of the batches this run was begun for."""
        return sinks.batches(self.spark, f"{self.staging}.{table}", self.pinned[table])

    def pending_dates(self, table: str) -> list[date]:
        """The load dates of those batches: one per landing since the last run."""
        return sorted({row[0] for row in self.pinned[table].select("upd_date").collect()})

    def history(self, table: str, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The rows of those batches that hold any of the wanted keys, consumed ones and those of this run, but none
        that landed meanwhile. Other batches are not read."""
        name = f"{self.staging}.{table}"
        dates = self.pinned[table].select("upd_date")
        if (before := self.consumed(table)) is not None:
            dates = dates.union(before.select("upd_date"))
        dates = dates.distinct()
        return sinks.batches(self.spark, name, sinks.holding(self.spark, name, wanted, keys, dates))

    def seed(self, rows, schema: str) -> DataFrame:
        return sources.seed(self.spark, rows, schema)


def run(spark: SparkSession, staging: str, target: str, batch_date: date | str) -> Run:
    """Bring all tables up to date with what has landed, in one commit.

    Raises ``sinks.Conflict`` if another run has committed meanwhile; then this one has changed nothing and its batches
    are still pending.
    """
    sinks.ensure_database(tune(spark), target)
    w = Run(spark, staging, target, batch_date)
    loaders = {"countries": load_countries, "cities": load_cities, "laureates": load_laureates}
    for source, load in loaders.items():
        with scratch_scope(spark):
            if not w.pin(source).isEmpty():
                load(w)
                w.mark_consumed(source)
    before = w.tables.number
    if w.tables.commit() > before:
        # The state before this run stays for readers that began with it; older ones go.
        w.tables.tidy()
    return w


def load_countries(w: Run) -> None:
    conformed = conforming.conform_countries(w.pending("countries"))
    names, continent_list, currency_list = (
        w.listed(t) for t in ("country_names", "country_continents", "country_currencies")
    )
    regions = w.publish("regions", reference.regions(conformed, w.stored("regions")))
    continents = w.publish("continents", reference.continents(continent_list, w.stored("continents")))
    currencies = w.publish("currencies", reference.currencies(currency_list, w.stored("currencies")))
    historical = w.seed([(name,) for name in fixed.HISTORICAL_COUNTRIES], "country_name string")
    # Each list is a snapshot of its own; all its rows, also those of no list, bear its date.
    for day in w.pending_dates("countries"):
        today = conformed.where(F.col("upd_date") == day)
        snapshot = geography.countries(
            today, conforming.missing_countries(names, today), historical, regions, continents, names, continent_list,
            w.listed("country_capital"), day, w.stored("country_ids"),
        )
        stored = w.put("countries", snapshot, day)
        w.merge("country_ids", stored.select("country_name", "country_id", "upd_date"), ["country_name"])
        newest = w.merge("countries_uptodate", stored, ["country_name"], history=w["countries"])
    codes = geography.country_codes(
        names, w.listed("country_iso3"), currency_list, w.listed("country_phones"), currencies, w.stored("country_codes")
    )
    codes = w.publish("country_codes", codes)
    pairs = w.publish("code_country_names", geography.codes_in_countries(codes, newest))
    w.publish("codes_in_countries", pairs.select("code_in_country_id", "country_code_id", "country_id"))


def load_cities(w: Run) -> None:
    conformed = conforming.conform_cities(w.pending("cities"))
    for day in w.pending_dates("cities"):
        today = conformed.where(F.col("upd_date") == day)
        labelled = geography.cities(today, w["code_country_names"], w.stored("city_ids"))
        labelled = w.put("cities_labelled", labelled, day)
        w.put("cities", labelled.drop("city_label", "country_code"), day)
        w.merge("city_ids", labelled.select("city_id", *geography.CITY_ROW, "upd_date"), ["city_id"])
        newest = w.merge("cities_labelled_uptodate", labelled, geography.CITY_KEY, ties="all", history=w["cities_labelled"])
    w.view("cities_uptodate", newest.drop("city_label", "country_code").columns, "cities_labelled_uptodate")
    seeds = w.seed(
        fixed.CITY_OVERRIDES, "mis_city_name string, orig_city_name string, orig_region string, orig_country string"
    )
    w.publish("city_overrides", geography.city_overrides(seeds, newest))


def load_laureates(w: Run) -> None:
    rows = conforming.conform_laureates(w.pending("laureates"))
    prize_types = w.publish("prize_types", reference.prize_types(rows, w.stored("prize_types")))
    laureate_types = w.publish("laureate_types", reference.laureate_types(rows, w.stored("laureate_types")))
    categories = w.publish("categories", reference.categories(rows, w.stored("categories")))
    genders = w.publish("genders", reference.genders(rows, w.stored("genders")))
    countries, cities, overrides = w["countries_uptodate"], w["cities_labelled_uptodate"], w["city_overrides"]

    w.merge("societies", laureates.societies(rows, None), ["society_name"], tiebreak=["laureate_id"])
    persons = laureates.persons(rows, genders, countries, cities, overrides, None)
    persons = w.merge("laureate_persons", persons, laureates.PERSON_KEY, tiebreak=["laureate_id"])

    seeds = w.seed(
        fixed.PARENT_ORGANIZATIONS, "organization_name string, organization_country string, organization_city string"
    )
    places = laureates.organization_places(rows, stamp(seeds, w.batch_date), w.stored("organization_places"))
    places = w.publish("organization_places", places)
    organizations = w.publish("organizations", laureates.organizations(places, countries, cities, overrides))
    w.publish("persons_in_orgs", laureates.persons_in_orgs(rows, places, w.stored("persons_in_orgs")))

    prizes = laureates.nobel_prizes(rows, categories, prize_types, laureate_types, w.stored("nobel_prizes"))
    # Only rows that are new by their key; what is stored already is not written again.
    w.add("nobel_prizes", prizes)

    # Rows of a laureate may arrive in several batches, so the touched keys are built from all that have any. Other
    # laureates are left out by their id alone, before anything else is done with the rows.
    theirs = versioning.only_keys(w.history("laureates", rows, ["laureate_id"]), rows, ["laureate_id"])
    touched = versioning.only_keys(conforming.conform_laureates(theirs), rows, wide.DATASET_KEY)
    touched = materialize(touched, "touched-rows")
    built = wide.dataset(
        touched, persons, places, organizations, countries, cities, w["regions"], w["continents"]
    )
    # The usual batch has new prizes alone, which are added; rows of known keys replace those there.
    w.merge("dataset", built, wide.DATASET_KEY)


def copy_out(w: Run, database: str) -> None:
    """Copy the warehouse into another database, each table in its own partitions and buckets."""
    sinks.ensure_database(w.spark, database)
    tables = [
        "cities", "countries", "dataset", "laureate_persons", "nobel_prizes", "organizations", "persons_in_orgs",
        "prize_types", "societies", *schemas.PLAIN_TABLES,
    ]
    layouts = {f"{database}.{t}": schemas.LAYOUTS.get(t, Layout()) for t in tables}
    sinks.copy_tables(w.spark, {w.name(t): f"{database}.{t}" for t in tables}, layouts)


PRIMARY_KEYS = {
    "nobel_prizes": ["nobel_prize_id"],
    "laureate_persons": ["laureate_id"],
    "societies": ["laureate_id"],
    "organizations": ["organization_id"],
    "persons_in_orgs": ["per_org_id"],
    "countries_uptodate": ["country_id"],
    "cities_uptodate": ["city_id"],
    "country_codes": ["country_code_id"],
    "codes_in_countries": ["code_in_country_id"],
    "categories": ["category_id"],
    "laureate_types": ["laureate_type_id"],
    "prize_types": ["prize_type_id"],
    "genders": ["gender_id"],
    "continents": ["continent_id"],
    "currencies": ["currency_code_id"],
    "regions": ["region_id"],
    "dataset": ["laureate_id", "prize"],
}

# What makes a row of a table one, beside its number.
LOGICAL_KEYS = {"nobel_prizes": laureates.PRIZE_KEY, "persons_in_orgs": ["laureate_id", "organization_id"]}

# Child table, its column, and the tables and columns one of which must have it.
FOREIGN_KEYS = [
    ("nobel_prizes", "laureate_type_id", [("laureate_types", "laureate_type_id")]),
    ("nobel_prizes", "category_id", [("categories", "category_id")]),
    ("nobel_prizes", "prize_type_id", [("prize_types", "prize_type_id")]),
    ("nobel_prizes", "laureate_id", [("laureate_persons", "laureate_id"), ("societies", "laureate_id")]),
    ("laureate_persons", "gender_id", [("genders", "gender_id")]),
    ("laureate_persons", "birth_city_id", [("cities_uptodate", "city_id")]),
    ("laureate_persons", "death_city_id", [("cities_uptodate", "city_id")]),
    ("laureate_persons", "birth_country_id", [("countries_uptodate", "country_id")]),
    ("laureate_persons", "death_country_id", [("countries_uptodate", "country_id")]),
    ("organizations", "organization_city_id", [("cities_uptodate", "city_id")]),
    ("organizations", "organization_country_id", [("countries_uptodate", "country_id")]),
    ("organizations", "parent_organization_id", [("organizations", "organization_id")]),
    ("persons_in_orgs", "organization_id", [("organizations", "organization_id")]),
    ("persons_in_orgs", "laureate_id", [("laureate_persons", "laureate_id")]),
    ("countries_uptodate", "region_id", [("regions", "region_id")]),
    ("countries_uptodate", "continent_id", [("continents", "continent_id")]),
    ("countries_uptodate", "parent_country_id", [("countries_uptodate", "country_id")]),
    ("country_codes", "currency_code_id", [("currencies", "currency_code_id")]),
    ("codes_in_countries", "country_code_id", [("country_codes", "country_code_id")]),
    ("codes_in_countries", "country_id", [("countries_uptodate", "country_id")]),
    ("cities_uptodate", "country_id", [("countries_uptodate", "country_id")]),
]

REQUIRED = {
    "nobel_prizes": ["nobel_prize_id", "category_id", "laureate_id", "laureate_type_id", "prize_type_id"],
    "laureate_persons": ["laureate_id", "full_name"],
    "societies": ["laureate_id", "society_name"],
    "organizations": ["organization_id", "organization_name"],
    "persons_in_orgs": ["per_org_id", "laureate_id", "organization_id"],
    "countries_uptodate": ["country_id", "country_name"],
    "cities_uptodate": ["city_id", "city_name"],
    "regions": ["region_id", "region_name"],
    "continents": ["continent_id", "continent_name"],
    "currencies": ["currency_code_id", "currency_code"],
    "country_codes": ["country_code_id", "code_name"],
    "codes_in_countries": ["code_in_country_id", "country_code_id", "country_id"],
    "categories": ["category_id", "category"],
    "laureate_types": ["laureate_type_id", "laureate_type"],
    "prize_types": ["prize_type_id", "prize_type"],
    "genders": ["gender_id", "gender"],
}


def audit(w: Run) -> dict[str, DataFrame]:
    """All findings on keys, references and required columns, by check."""
    findings: dict[str, DataFrame] = {}
    for table, key in PRIMARY_KEYS.items():
        findings[f"unique {table}"] = quality.audit_unique(w[table], key)
    for table, key in LOGICAL_KEYS.items():
        findings[f"logical key {table}"] = quality.audit_unique(w[table], key)
    for table, column, parents in FOREIGN_KEYS:
        findings[f"reference {table}.{column}"] = quality.audit_fk(
            w[table], [column], [(w[parent], [key]) for parent, key in parents]
        )
    for table, columns in REQUIRED.items():
        findings[f"required {table}"] = quality.audit_not_null(w[table], columns).where("nulls > 0")
    return findings


def checks() -> list[quality.Check]:
    """The same checks as ``audit``, declared."""
    unique = [*PRIMARY_KEYS.items(), *LOGICAL_KEYS.items()]
    return [
        *[quality.Check(table, "unique", key) for table, key in unique],
        *[quality.Check(table, "reference", [column], [(p, [key]) for p, key in parents]) for table, column, parents in FOREIGN_KEYS],
        *[quality.Check(table, "required", columns) for table, columns in REQUIRED.items()],
    ]


def audit_once(w: Run) -> DataFrame:
    """All findings of ``audit`` as one table, for which every table is scanned once."""
    declared = checks()
    names = dict.fromkeys([c.table for c in declared] + [p for c in declared for p, _ in c.parents])
    return quality.audit_tables({name: w[name] for name in names}, declared)


def keep_findings(w: Run) -> None:
    """Store the findings of a run under its date, in place of those that the date had, in a commit of their own."""
    w.tables.put("findings", stamp(audit_once(w), w.batch_date), "upd_date", w.batch_date)
    w.tables.commit()


def audit_files(
    spark: SparkSession, paths: Mapping[str, str]
) -> dict[str, DataFrame]:
    """Texts of the incoming files that do not fit their declared type or length."""
    declared = {
        "laureates": (schemas.LAUREATE_FILE, schemas.LAUREATE_LENGTHS),
        "countries": (schemas.COUNTRY_FILE, schemas.COUNTRY_LENGTHS),
    }
    return {
        name: quality.audit_cast(sources.read_csv_text(spark, path, declared[name][0]), *declared[name]).where(
            (F.col("bad_casts") > 0) | (F.col("too_long") > 0)
        )
        for name, path in paths.items()
    }
