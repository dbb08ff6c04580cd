"""The loaders of the warehouse over sources derived from the given tables."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from snowloom import sinks, sources
from snowloom.operators import enrich, keys
from snowloom.operators.enrich import ParentRule
from snowloom.plans import conforming, geography, laureates, reference, schemas, staging
from snowloom.plans import dataset as wide
from snowloom.plans import fixed_values as fixed
from snowloom.queries.registry import Tables, query
from snowloom.queries.world import common, frame
from snowloom.session import materialize, scratch_folder, setting

FIRST, SECOND = "upd_date = DATE '2024-01-07'", "upd_date = DATE '2024-01-14'"


def _landed(t: Tables, *columns: str):
    """The laureate rows as a landed table, which every loader reads; of a loader of some columns, all rows of these."""
    return materialize(frame(t, "laureates").select(*columns or "*"), "landed-laureates")


def _staging(t: Tables) -> str:
    name = f"stg_{uuid.uuid4().hex}"
    sinks.ensure_database(t.spark, name, scratch_folder(t.spark, "staging"))
    return name


# --- staging ---------------------------------------------------------------------------------------


@query("""
SELECT lower(c_name) AS city_name, c_name AS accent_city_name, c_mktsegment AS city_region,
       CAST(floor(c_acctbal) AS INTEGER) AS population, CAST(c_custkey % 90 AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
       'n' || c_nationkey AS country_code, DATE '2024-01-07' AS upd_date FROM customer
""")
def load_staging_cities(t: Tables):
    """The city table as a database gives it; a coordinate that does not fit its type becomes null."""
    table = t.customer.select(
        F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("country"), F.lower("c_name").alias("city"),
        F.col("c_name").alias("accentcity"), F.col("c_mktsegment").alias("region"),
        F.floor("c_acctbal").cast("double").alias("population"), (F.col("c_custkey") % 90).cast("double").alias("latitude"),
        F.lit(12345.5).alias("longitude"),
    )
    target = f"{_staging(t)}.cities"
    staging.land_cities(table, target, date(2024, 1, 7))
    return t.spark.table(target).withColumns({c: F.col(c).cast("double") for c in ("latitude", "longitude")})


@query("""
SELECT c_name AS country_name, c_mktsegment AS region, CAST(c_custkey AS INTEGER) AS population,
       CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_nationkey AS DOUBLE) END AS climate, DATE '2024-01-07' AS upd_date FROM customer
""")
def load_staging_countries(t: Tables):
    """Country files with values that do not fit their type."""
    path = scratch_folder(t.spark, "country-files")
    values = {
        "country": F.col("c_name"), "region": F.col("c_mktsegment"), "population": F.col("c_custkey").cast("string"),
        "climate": F.when(F.col("c_custkey") % 4 == 0, F.lit("warm")).otherwise(F.col("c_nationkey").cast("string")),
    }
    names = [f.split()[0] for f in schemas.COUNTRY_FILE.split(", ")]
    rows = t.customer.select(*[values.get(n, F.lit("1")).alias(n.title()) for n in names])
    rows.write.option("header", True).option("quoteAll", True).csv(path)
    target = f"{_staging(t)}.countries"
    staging.land_countries(t.spark, path, target, date(2024, 1, 7))
    landed = t.spark.table(target).withColumn("climate", F.col("climate").cast("double"))
    return landed.select("country_name", "region", "population", "climate", "upd_date")


@query(common("laureates") + """
SELECT year, category, prize, motivation, laureate_id, laureate_type, full_name, birth_date, gender, organization_name,
       organization_city, death_date, DATE '2024-01-21' AS upd_date FROM (SELECT DISTINCT * EXCLUDE upd_date FROM laureates)
""")
def load_staging_laureates(t: Tables):
    """Laureate files landed twice: one copy stays."""
    path = scratch_folder(t.spark, "laureate-files")
    # A prize names its order. With the order's key among the columns, copies are dropped where the join has brought
    # the order's lines together, and the wide rows need no shuffle of their own.
    rows = frame(t, "laureates", "o_orderkey").drop("upd_date").distinct()
    names = [f.split()[0] for f in schemas.LAUREATE_FILE.split(", ")]
    files = rows.select(*[F.col(n).alias(n.replace("_", " ").title()) for n in names])
    # Rows are many times as wide as the keys they are joined by, so a task gets few keys.
    with setting(t.spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m"):
        files.write.option("header", True).option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False
        ).option("compression", "gzip").csv(path)
    target = f"{_staging(t)}.laureates"
    # Compressed files hold some ten times their size.
    with setting(t.spark, "spark.sql.files.maxPartitionBytes", "16m"):
        for _ in range(2):
            staging.land_laureates(t.spark, path, target, date(2024, 1, 21))
    return t.spark.table(target).select(
        "year", "category", "prize", "motivation",
        F.col("laureate_id").cast("long").alias("laureate_id"), "laureate_type", "full_name", "birth_date", "gender",
        "organization_name", "organization_city", "death_date", "upd_date",
    )


@query("SELECT CAST(p_partkey AS VARCHAR) AS country_code, p_name AS capital_name FROM part")
def load_code_list(t: Tables):
    path = scratch_folder(t.spark, "code-files")
    t.part.select(F.col("p_partkey").cast("string").alias("country"), F.col("p_name").alias("capital")).write.json(path)
    target = f"{_staging(t)}.country_capital"
    staging.land_code_list(t.spark, "country_capital", path, target)
    return t.spark.table(target)


# --- conforming ------------------------------------------------------------------------------------


@query("SELECT c_name AS country_name, 'C' || c_custkey AS country_code FROM customer WHERE c_acctbal <= 300")
def load_missing_countries(t: Tables):
    listed = conforming.conform_countries(frame(t, "listed"))
    return conforming.missing_countries(frame(t, "code_names"), listed)


_ALIASED = "CASE o_custkey % 5 WHEN 0 THEN 'United States of America' WHEN 1 THEN 'Germany (Poland)' WHEN 2 THEN 'India (Pakistan)' WHEN 3 THEN 'Norway' END"
_PATCHED = "CASE o_orderkey % 4 WHEN 0 THEN 'Howard Hughes Medical Institute ' WHEN 1 THEN 'Institut Pasteur' WHEN 2 THEN 'University of Delaware' END"
_CONFORMED = "CASE o_custkey % 5 WHEN 0 THEN 'United States' WHEN 1 THEN 'Germany' WHEN 2 THEN 'India' WHEN 3 THEN 'Norway' END"


@query(f"""
SELECT o_orderkey, {_CONFORMED} AS birth_country, {_CONFORMED} AS death_country,
       CASE WHEN o_orderkey % 4 = 0 THEN 'United States' WHEN o_orderkey % 4 = 1 AND o_orderstatus = 'F' THEN 'Tunisia' ELSE {_CONFORMED} END AS organization_country,
       CASE WHEN o_orderkey % 4 = 0 THEN 'Durham, NC' WHEN o_orderkey % 4 = 2 THEN 'Newark, DE' WHEN o_orderstatus = 'F' THEN 'Tunis' END AS organization_city
FROM orders
""")
def load_conformed_laureates(t: Tables):
    """Aliases in three roles; places of some organizations patched, the country after the city."""
    rows = t.orders.select(
        "o_orderkey", *[F.expr(_ALIASED).alias(f"{role}_country") for role in ("birth", "death", "organization")],
        F.expr(_PATCHED).alias("organization_name"), F.expr("CASE WHEN o_orderstatus = 'F' THEN 'Tunis' END").alias("organization_city"),
    )
    return conforming.conform_laureates(rows).drop("organization_name")


@query("""
SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN c_name || ', ' || c_mktsegment ELSE c_name END AS city_label FROM customer
""")
def load_conformed_cities(t: Tables):
    cities = t.customer.select(
        "c_custkey", F.when(F.col("c_nationkey") % 2 == 0, "us").otherwise("de").alias("country_code"),
        F.col("c_name").alias("accent_city_name"), F.col("c_mktsegment").alias("city_region"),
    )
    return conforming.conform_cities(cities).select("c_custkey", "city_label")


# --- reference tables ------------------------------------------------------------------------------

_IDS = """
  seen AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS id FROM (SELECT DISTINCT v FROM before WHERE v IS NOT NULL)),
  fresh AS (SELECT DISTINCT v FROM after WHERE v IS NOT NULL AND v NOT IN (SELECT v FROM seen)),
  ids AS (SELECT v, id FROM seen UNION ALL SELECT v, (SELECT coalesce(max(id), -1) FROM seen) + row_number() OVER (ORDER BY v) FROM fresh)"""


@query(common("laureates") + f""",
  before AS (SELECT prize AS v FROM laureates WHERE {FIRST}), after AS (SELECT prize AS v FROM laureates WHERE {SECOND}), {_IDS}
SELECT id AS prize_type_id, v AS prize_type, max(upd_date) AS upd_date FROM ids JOIN laureates ON prize = v GROUP BY 1, 2
""")
def load_prize_types(t: Tables):
    """Two loads; prizes of the first keep their id."""
    rows = _landed(t)
    return reference.prize_types(rows.where(SECOND), reference.prize_types(rows.where(FIRST), None))


@query(common("laureates") + f""",
  before AS (SELECT category AS v FROM laureates WHERE {FIRST} AND category < '3'), after AS (SELECT category AS v FROM laureates WHERE {SECOND}), {_IDS}
SELECT 'category' AS kind, id, v AS value FROM ids
UNION ALL SELECT 'gender', CASE v WHEN 'Female' THEN 0 ELSE 1 END, v FROM (SELECT DISTINCT gender AS v FROM laureates WHERE gender IS NOT NULL)
UNION ALL SELECT 'laureate type', CASE v WHEN 'Individual' THEN 0 ELSE 1 END, v FROM (SELECT DISTINCT laureate_type AS v FROM laureates)
""")
def load_small_dimensions(t: Tables):
    """Categories over two loads, genders without null, laureate types."""
    rows = _landed(t)
    before = reference.categories(rows.where(FIRST).where("category < '3'"), None)
    parts = [
        ("category", reference.categories(rows.where(SECOND), before), "category_id", "category"),
        ("gender", reference.genders(rows, None), "gender_id", "gender"),
        ("laureate type", reference.laureate_types(rows, None), "laureate_type_id", "laureate_type"),
    ]
    first, *rest = [
        df.select(F.lit(kind).alias("kind"), F.col(i).alias("id"), F.col(v).alias("value")) for kind, df, i, v in parts
    ]
    return first.union(rest[0]).union(rest[1])


@query("""
SELECT 'region' AS kind, row_number() OVER (ORDER BY v) - 1 AS id, v AS code, v AS label FROM (SELECT DISTINCT c_mktsegment AS v FROM customer)
UNION ALL SELECT 'currency', row_number() OVER (ORDER BY v) - 1, v, v FROM (SELECT DISTINCT event_type AS v FROM events WHERE event_type <> 'view')
UNION ALL SELECT 'continent', row_number() OVER (ORDER BY v) - 1, v, CASE v WHEN 'AS' THEN 'ASIA' WHEN 'EU' THEN 'EUROPE' ELSE '' END
FROM (SELECT DISTINCT CASE WHEN user_id % 3 = 0 THEN 'AS' WHEN user_id % 3 = 1 THEN 'EU' ELSE 'Z' || user_id END AS v FROM events)
""")
def load_code_dimensions(t: Tables):
    """Regions; currencies without the empty code; continents with a label, '' for an unknown code."""
    regions = reference.regions(t.customer.select(F.col("c_mktsegment").alias("region")), None)
    code = F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("event_type"))
    currencies = reference.currencies(t.events.select(code.alias("currency_code")), None)
    by_user = F.when(F.col("user_id") % 3 == 0, "AS").when(F.col("user_id") % 3 == 1, "EU")
    by_user = by_user.otherwise(F.concat(F.lit("Z"), F.col("user_id").cast("string")))
    continents = reference.continents(t.events.select(by_user.alias("continent_code")), None)

    def part(kind, df, i, c, label):
        return df.select(F.lit(kind).alias("kind"), F.col(i).alias("id"), F.col(c).alias("code"), F.col(label).alias("label"))

    return (
        part("region", regions, "region_id", "region_name", "region_name")
        .union(part("currency", currencies, "currency_code_id", "currency_code", "currency_code"))
        .union(part("continent", continents, "continent_id", "continent_code", "continent_name"))
    )


# --- geography -------------------------------------------------------------------------------------

_COUNTRY_RULES = [
    ParentRule({"country_name": ["%-OLD", "Supplier#000000003"]}, {"country_name": "Customer#000000001"}),
    ParentRule({"country_name": ["%7"]}, {"country_name": "Customer#000000013"}),
    ParentRule({"country_name": ["Supplier%"]}, {"country_name": "no such country"}),
]


@query(common("listed") + """,
  today AS (SELECT trim(country_name) AS country_name, trim(region) AS region, population, climate FROM listed UNION ALL
    SELECT c_name, NULL, NULL, NULL FROM customer WHERE c_acctbal <= 300),
  ids AS (SELECT row_number() OVER (ORDER BY country_name) - 1 AS country_id, * FROM today),
  past AS (SELECT row_number() OVER (ORDER BY n) - 1 + (SELECT count(*) FROM ids) AS country_id, n,
      CASE WHEN n LIKE '%-OLD' OR n = 'Supplier#000000003' THEN (SELECT country_id FROM ids WHERE country_name = 'Customer#000000001')
           WHEN n LIKE '%7' THEN (SELECT country_id FROM ids WHERE country_name = 'Customer#000000013') END AS parent_country_id
    FROM (SELECT CASE WHEN s_suppkey % 5 = 0 THEN s_name || '-OLD' ELSE s_name END AS n FROM supplier)),
  every AS (SELECT country_id, country_name, region, population, climate, NULL AS parent_country_id FROM ids
    UNION ALL SELECT country_id, n, NULL, NULL, NULL, parent_country_id FROM past)
SELECT e.country_id, e.country_name, e.parent_country_id, s.id AS region_id, c_custkey % 3 AS continent_id,
       CASE WHEN c_custkey % 6 <> 0 THEN 'Capital ' || c_custkey END AS capital_name,
       e.population, CAST(e.climate AS DOUBLE) AS climate, DATE '2024-01-07' AS upd_date
FROM every e LEFT JOIN customer ON c_name = e.country_name
LEFT JOIN (SELECT seg, row_number() OVER (ORDER BY seg) - 1 AS id FROM (SELECT DISTINCT c_mktsegment AS seg FROM customer)) s ON s.seg = e.region
""")
def load_countries(t: Tables):
    """Listed, missing and historical countries with ids, parents, continents and capitals."""
    conformed, names = conforming.conform_countries(frame(t, "listed")), frame(t, "code_names")
    regions = t.customer.select(F.col("c_mktsegment").alias("region_name")).distinct()
    regions = reference.regions(regions.select(F.col("region_name").alias("region")), None)
    code = F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("country_code")
    kind = F.concat(F.lit("K"), (F.col("c_custkey") % 3).cast("string")).alias("continent_code")
    capital = F.when(F.col("c_custkey") % 6 == 0, "").otherwise(F.concat(F.lit("Capital "), F.col("c_custkey").cast("string")))
    past = F.when(F.col("s_suppkey") % 5 == 0, F.concat("s_name", F.lit("-OLD"))).otherwise(F.col("s_name"))
    # Every customer has some measures; the rest of the list is empty here.
    for measure in schemas.COUNTRY_MEASURES:
        if measure not in conformed.columns:
            conformed = conformed.withColumn(measure, F.lit(None).cast("int"))
    rows = geography.countries(
        conformed, conforming.missing_countries(names, conformed), t.supplier.select(past.alias("country_name")), regions,
        frame(t, "continents"), names, t.customer.select(code, kind), t.customer.select(code, capital.alias("capital_name")),
        date(2024, 1, 7), None, _COUNTRY_RULES,
    )
    return rows.select(
        "country_id", "country_name", "parent_country_id", "region_id", "continent_id", "capital_name", "population",
        F.col("climate").cast("double").alias("climate"), "upd_date",
    )


@query("""
SELECT row_number() OVER (ORDER BY c_name, c_custkey) - 1 AS country_code_id, c_name AS code_name, 'C' || c_custkey AS iso2_code,
       CASE WHEN c_nationkey < 12 THEN 'I' || c_custkey END AS iso3_code,
       CASE WHEN c_acctbal > 1000 THEN s.id END AS currency_code_id,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_nationkey AS VARCHAR) END AS phone_code
FROM customer LEFT JOIN (SELECT seg, row_number() OVER (ORDER BY seg) - 1 AS id FROM
  (SELECT DISTINCT c_mktsegment AS seg FROM customer WHERE c_mktsegment <> 'MACHINERY' AND c_acctbal > 1000)) s ON s.seg = c_mktsegment
""")
def load_country_codes(t: Tables):
    """Each list joined on the code of the name: a missing currency or phone loses nothing else."""
    code = F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("country_code")
    currency = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).otherwise("").alias("currency_code")
    currency_list = t.customer.where("c_acctbal > 1000").select(code, currency)
    return geography.country_codes(
        t.customer.select(code, F.col("c_name").alias("country_name")),
        t.customer.where("c_nationkey < 12").select(code, F.concat(F.lit("I"), F.col("c_custkey").cast("string")).alias("iso3_code")),
        currency_list,
        t.customer.where("c_mktsegment <> 'BUILDING'").select(code, F.col("c_nationkey").cast("string").alias("phone_code")),
        reference.currencies(currency_list, None),
    )


@query("""
WITH first AS (SELECT c_custkey, row_number() OVER (ORDER BY c_name, c_custkey) - 1 AS id FROM customer WHERE c_custkey % 2 = 1),
  later AS (SELECT c_custkey, (SELECT max(id) FROM first) + row_number() OVER (ORDER BY c_name, c_custkey) AS id FROM customer WHERE c_custkey % 2 = 0)
SELECT id AS country_code_id, c_name AS code_name, 'C' || c_custkey AS iso2_code, 'I' || c_custkey AS iso3_code
FROM customer JOIN (SELECT * FROM first UNION ALL SELECT * FROM later) USING (c_custkey)
""")
def load_country_codes_two_loads(t: Tables):
    """A longer list of names, the new ones between the old: no id changes."""
    code = F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("country_code")
    names = t.customer.select(code, F.col("c_name").alias("country_name"), "c_custkey")
    iso3 = t.customer.select(code, F.concat(F.lit("I"), F.col("c_custkey").cast("string")).alias("iso3_code"))
    currency = t.customer.select(code, F.col("c_mktsegment").alias("currency_code"))
    phones = t.customer.select(code, F.lit("1").alias("phone_code"))
    lists = (iso3, currency, phones, reference.currencies(currency, None))
    before = materialize(geography.country_codes(names.where("c_custkey % 2 = 1"), *lists), "country-codes")
    return geography.country_codes(names, *lists, before).select("country_code_id", "code_name", "iso2_code", "iso3_code")


_CODES = "CASE WHEN c_custkey = 1 THEN 'BQ' WHEN c_custkey = 2 THEN 'CW' WHEN c_custkey = 3 THEN 'PS' ELSE concat('C', CAST(c_custkey AS STRING)) END"
_NAMES = "CASE WHEN c_custkey = 5 THEN 'Netherlands Antilles' WHEN c_custkey = 6 THEN 'Gaza Strip' WHEN c_custkey = 7 THEN 'West Bank' ELSE c_name END"


@query(f"""
WITH codes AS (SELECT c_custkey AS country_code_id, {_CODES} AS iso2, c_name AS code_name FROM customer WHERE c_acctbal > 500 OR c_custkey < 10),
  named AS (SELECT c_custkey + 5000000 AS country_id, {_NAMES} AS country_name, c_mktsegment = 'HOUSEHOLD' AND c_custkey >= 10 AS old FROM customer WHERE c_acctbal < 9000 OR c_custkey < 10),
  pairs AS (SELECT CASE WHEN country_name IN ('Gaza Strip', 'West Bank') THEN 'PS' ELSE iso2 END AS iso2,
                   CASE WHEN iso2 IN ('BQ', 'CW') THEN 'Netherlands Antilles' ELSE country_name END AS country_name
            FROM codes FULL OUTER JOIN (SELECT * FROM named WHERE NOT old) n ON code_name = n.country_name)
SELECT row_number() OVER (ORDER BY country_code_id, country_id) - 1 AS code_in_country_id, p.iso2 AS iso2_code,
       p.country_name, country_code_id, country_id
FROM (SELECT DISTINCT * FROM pairs WHERE iso2 IS NOT NULL AND country_name IS NOT NULL) p JOIN codes USING (iso2) JOIN named USING (country_name)
""")
def load_codes_in_countries(t: Tables):
    """Codes matched to countries by name, on either side alone, and by the stated pairs."""
    codes = t.customer.where("c_acctbal > 500 OR c_custkey < 10").select(
        F.col("c_custkey").alias("country_code_id"), F.expr(_CODES).alias("iso2_code"), F.col("c_name").alias("code_name")
    )
    number = F.col("c_custkey") + 5000000
    countries = t.customer.where("c_acctbal < 9000 OR c_custkey < 10").select(
        number.alias("country_id"), F.expr(_NAMES).alias("country_name"),
        F.expr("CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_custkey >= 10 THEN 0 END").alias("parent_country_id"),
    )
    return geography.codes_in_countries(codes, countries).select(
        "code_in_country_id", "iso2_code", "country_name", "country_code_id", "country_id"
    )


_CITY_CODE = "CASE c_nationkey WHEN 0 THEN 'ps' WHEN 1 THEN 'an' WHEN 2 THEN 'zr' WHEN 3 THEN 'us' ELSE concat('n', CAST(c_nationkey AS STRING)) END"


@query(f"""
WITH placed AS (SELECT *, {_CITY_CODE} AS code, CASE WHEN c_custkey % 8 <> 0 THEN 30 + c_custkey % 10 END AS lon FROM customer),
  known AS (SELECT *, CASE WHEN code = 'ps' AND lon <= 34.8 THEN 501 WHEN code = 'ps' AND lon > 34.8 THEN 502 WHEN code = 'an' THEN 503
                          WHEN code = 'ps' THEN NULL WHEN code = 'us' THEN 1003 ELSE 1000 + c_nationkey END AS country_id FROM placed WHERE code <> 'zr'),
  before AS (SELECT *, row_number() OVER (ORDER BY country_id NULLS FIRST, c_name) - 1 AS id FROM known WHERE c_mktsegment = 'MACHINERY'),
  later AS (SELECT *, (SELECT max(id) FROM before) + row_number() OVER (ORDER BY country_id NULLS FIRST, c_name) AS id FROM known WHERE c_mktsegment <> 'MACHINERY')
SELECT id AS city_id, c_name AS accent_city_name, CAST(country_id AS BIGINT) AS country_id, c_mktsegment AS city_region, code AS country_code,
       CASE WHEN code = 'us' THEN c_name || ', ' || c_mktsegment ELSE c_name END AS city_label, DATE '2024-01-14' AS upd_date
FROM (SELECT * FROM before UNION ALL SELECT * FROM later)
""")
def load_cities(t: Tables):
    """Cities with merged, split and dropped codes; a second list keeps the ids of the first."""
    places = t.customer.select(
        F.lower("c_name").alias("city_name"), F.col("c_name").alias("accent_city_name"), F.col("c_mktsegment").alias("city_region"),
        F.floor("c_acctbal").cast("int").alias("population"), F.lit(1).cast("decimal(20,17)").alias("latitude"),
        F.when(F.col("c_custkey") % 8 != 0, 30 + F.col("c_custkey") % 10).cast("decimal(20,17)").alias("longitude"),
        F.expr(_CITY_CODE).alias("country_code"), "c_custkey",
    )
    conformed = conforming.conform_cities(places)
    pairs = t.nation.select(
        F.expr("CASE n_nationkey WHEN 0 THEN 'PS' WHEN 1 THEN 'BQ' WHEN 2 THEN 'ZR' WHEN 3 THEN 'US' ELSE concat('N', CAST(n_nationkey AS STRING)) END").alias("iso2_code"),
        F.expr("CASE n_nationkey WHEN 0 THEN 'Gaza Strip' WHEN 1 THEN 'Netherlands Antilles' ELSE n_name END").alias("country_name"),
        F.expr("CASE n_nationkey WHEN 0 THEN 501 WHEN 1 THEN 503 ELSE 1000 + n_nationkey END").cast("long").alias("country_id"),
    )
    pairs = pairs.union(t.nation.where("n_nationkey = 0").select(F.lit("PS"), F.lit("West Bank"), F.lit(502).cast("long")))
    pairs = pairs.union(t.nation.where("n_nationkey = 1").select(F.lit("CW"), F.lit("Netherlands Antilles"), F.lit(503).cast("long")))
    before = materialize(geography.cities(sinks.stamp(conformed.where("city_region = 'MACHINERY'"), date(2024, 1, 7)), pairs, None), "cities")
    rows = geography.cities(sinks.stamp(conformed, date(2024, 1, 14)), pairs, before)
    return rows.select("city_id", "accent_city_name", "country_id", "city_region", "country_code", "city_label", "upd_date")


@query("""
WITH seen AS (SELECT *, row_number() OVER (ORDER BY c_nationkey, c_mktsegment, c_acctbal, c_custkey) - 1 AS id FROM customer WHERE c_custkey % 5 <> 0),
  fresh AS (SELECT *, (SELECT max(id) FROM seen) + row_number() OVER (ORDER BY c_nationkey, c_mktsegment, c_acctbal, c_custkey) AS id
            FROM customer WHERE c_custkey % 5 = 0)
SELECT id AS city_id, 'n' || c_nationkey AS country_code, c_mktsegment AS city_region, c_name AS accent_city_name, c_acctbal AS population
FROM (SELECT * FROM seen UNION ALL SELECT * FROM fresh)
""".replace("c_nationkey, c_mktsegment, c_acctbal, c_custkey", "c_nationkey, c_name"))
def load_cities_moved(t: Tables):
    """A second list in which every city has other coordinates: known cities keep their ids, new ones follow."""

    def listed(where: str, north: float, day: date):
        rows = t.customer.where(where).select(
            F.lower("c_name").alias("city_name"), F.col("c_name").alias("accent_city_name"), F.col("c_mktsegment").alias("city_region"),
            F.col("c_acctbal").alias("population"), (F.col("c_custkey") % 80 + north).cast("decimal(20,17)").alias("latitude"),
            F.lit(1).cast("decimal(20,17)").alias("longitude"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("country_code"),
        )
        return sinks.stamp(conforming.conform_cities(rows), day)

    pairs = t.nation.select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("iso2_code"), F.col("n_name").alias("country_name"),
        F.col("n_nationkey").cast("long").alias("country_id"),
    )
    before = materialize(geography.cities(listed("c_custkey % 5 <> 0", 0.0, date(2024, 1, 7)), pairs, None), "cities")
    rows = geography.cities(listed("true", 0.5, date(2024, 1, 14)), pairs, before)
    return rows.select("city_id", "country_code", "city_region", "accent_city_name", "population")


_OVERRIDDEN = [row[0] for row in fixed.CITY_OVERRIDES]
_PAST = list(fixed.HISTORICAL_COUNTRIES)


def _text(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


@query(f"""
WITH c AS (SELECT c_custkey, {_text(_OVERRIDDEN)}[c_custkey % {len(_OVERRIDDEN)} + 1] AS city, {_text(_PAST)}[c_custkey % {len(_PAST)} + 1] AS country,
    {_text([row[0] for row in fixed.PARENT_ORGANIZATIONS])}[c_custkey % 4 + 1] AS organization FROM customer)
SELECT c_custkey, {_text([row[1] for row in fixed.CITY_OVERRIDES])}[c_custkey % {len(_OVERRIDDEN)} + 1] AS original_city,
  c.country AS historical_country, {_text([row[2] for row in fixed.PARENT_ORGANIZATIONS])}[c_custkey % 4 + 1] AS organization_city FROM c
""")
def load_seeds(t: Tables):
    """Names of customers looked up in the three seed lists; one in four has an organization of none."""

    def nth(values, n):
        return F.get(F.array(*map(F.lit, values)), (F.col("c_custkey") % n).cast("int"))

    rows = t.customer.select(
        "c_custkey", F.concat(nth(_OVERRIDDEN, len(_OVERRIDDEN)), F.lit("  ")).alias("city"), nth(_PAST, len(_PAST)).alias("country"),
        nth([row[0] for row in fixed.PARENT_ORGANIZATIONS], 4).alias("organization"),
    )
    cities = sources.seed(t.spark, fixed.CITY_OVERRIDES, "mis_city_name string, orig_city_name string, orig_region string, orig_country string")
    past = sources.seed(t.spark, [(name,) for name in _PAST], "country_name string")
    parents = sources.seed(t.spark, fixed.PARENT_ORGANIZATIONS, "organization_name string, organization_country string, organization_city string")
    rows = enrich.lookup(rows, cities, {"city": "mis_city_name"}, {"orig_city_name": "original_city"}, lowest=True)
    rows = enrich.lookup(rows, past.distinct(), {"country": "country_name"}, {"country_name": "historical_country"})
    rows = enrich.lookup(rows, parents, {"organization": "organization_name"}, ["organization_city"])
    return rows.select("c_custkey", "original_city", "historical_country", "organization_city")


@query("""
SELECT s_suppkey, (SELECT min(c_custkey) FROM customer WHERE c_custkey % 100 = s_suppkey AND c_nationkey = s_nationkey) AS city_id FROM supplier
""")
def load_city_overrides(t: Tables):
    """The city behind a name the city list does not have; of several the lowest id."""
    cities = t.customer.select(
        F.col("c_custkey").alias("city_id"), _tag(F.col("c_custkey") % 100).alias("accent_city_name"),
        F.lit("r").alias("city_region"), F.col("c_nationkey").cast("string").alias("country_code"),
    )
    seeds = t.supplier.select(
        "s_suppkey", F.col("s_name").alias("mis_city_name"), F.concat(_tag(F.col("s_suppkey")), F.lit("  ")).alias("orig_city_name"),
        F.lit("r  ").alias("orig_region"), F.col("s_nationkey").cast("string").alias("orig_country"),
    )
    return geography.city_overrides(seeds, cities).select("s_suppkey", "city_id")


def _tag(c):
    return F.concat(F.lit("T"), c.cast("string"))


# --- laureates -------------------------------------------------------------------------------------


@query(common("laureates") + """
SELECT laureate_id, full_name AS society_name, max(upd_date) AS upd_date FROM laureates WHERE laureate_type = 'Organization' GROUP BY 1, 2
""")
def load_societies(t: Tables):
    rows = _landed(t)
    return laureates.societies(rows.where(SECOND), laureates.societies(rows.where(FIRST), None))


def _place(role: str) -> str:
    return f"""
  {role}_c AS (SELECT p.laureate_id, c.country_id, c.parent_country_id FROM people p LEFT JOIN countries c ON trim(c.country_name) = trim(p.{role}_country)),
  {role}_p AS (SELECT p.laureate_id, k.country_id, coalesce(
      (SELECT min(city_id) FROM cities x WHERE x.city_label = trim(p.{role}_city) AND x.country_id = k.country_id),
      (SELECT min(city_id) FROM cities x WHERE x.city_label = trim(p.{role}_city) AND x.country_id = k.parent_country_id),
      (SELECT min(city_id) FROM city_overrides x WHERE trim(x.mis_city_name) = trim(p.{role}_city))) AS city_id
    FROM people p JOIN {role}_c k USING (laureate_id))"""


@query(common("laureates", "countries", "cities", "city_overrides") + f""",
  people AS (SELECT laureate_id, full_name, gender, birth_date, birth_city, birth_country, death_date, death_city, death_country,
      max(upd_date) AS upd_date FROM laureates WHERE laureate_type = 'Individual' GROUP BY ALL), {_place("birth")}, {_place("death")}
SELECT laureate_id, full_name, CAST(CASE gender WHEN 'Female' THEN 0 ELSE 1 END AS BIGINT) AS gender_id, birth_date, b.city_id AS birth_city_id,
       b.country_id AS birth_country_id, death_date, d.city_id AS death_city_id, d.country_id AS death_country_id, upd_date
FROM people JOIN birth_p b USING (laureate_id) JOIN death_p d USING (laureate_id)
""")
def load_persons(t: Tables):
    """Birth and death places by country, parent country and override; two loads, the newest row stays."""
    rows = _landed(t)
    dims = [reference.genders(rows, None), *[frame(t, n) for n in ("countries", "cities", "city_overrides")]]
    before = materialize(laureates.persons(rows.where(FIRST), *dims, None), "persons")
    return laureates.persons(rows.where(SECOND), *dims, before)


_ORG_RULES = [
    ParentRule({"organization_name": ["%1"], "organization_city": ["City 1"]}, {"organization_name": "Supplier#000000002", "organization_country": "Country 16"}),
    ParentRule({"organization_name": ["%3", "Supplier#000000004"]}, {"organization_name": "Supplier#000000005"}, unless={"organization_city": ["City 13"]}),
]
_ORGS = """,
  orgs AS (SELECT trim(organization_name) AS name, organization_country AS country, organization_city AS city, min(upd_date) AS since, max(upd_date) AS upd_date
    FROM laureates WHERE laureate_type = 'Individual' AND organization_name IS NOT NULL GROUP BY 1, 2, 3),
  seen AS (SELECT row_number() OVER (ORDER BY name, country, city) - 1 AS id, * FROM orgs WHERE since = DATE '2024-01-07'),
  seeded AS (SELECT * FROM seen UNION ALL SELECT (SELECT max(id) FROM seen) + 1, 'Seed University', 'Country 1', 'City 1', DATE '2024-01-01', DATE '2024-01-01'),
  places AS (SELECT * FROM seeded UNION ALL SELECT (SELECT max(id) FROM seeded) + row_number() OVER (ORDER BY name, country, city), * FROM orgs WHERE since > DATE '2024-01-07')"""


def _organization_places(t: Tables, rows):
    seeds = t.region.where("r_regionkey = 0").select(
        F.lit("Seed University").alias("organization_name"), F.lit("Country 1").alias("organization_country"),
        F.lit("City 1").alias("organization_city"), F.lit("2024-01-01").cast("date").alias("upd_date"),
    )
    before = laureates.organization_places(rows.where(FIRST), seeds, None)
    before = materialize(before, "organization-places")
    return materialize(laureates.organization_places(rows.where(SECOND), seeds, before), "organization-places")


@query(common("laureates", "countries", "cities", "city_overrides") + _ORGS + """
SELECT p.id AS organization_id, p.name AS organization_name, c.country_id AS organization_country_id, coalesce(
      (SELECT min(city_id) FROM cities x WHERE x.city_label = p.city AND x.country_id = c.country_id),
      (SELECT min(city_id) FROM city_overrides x WHERE trim(x.mis_city_name) = p.city)) AS organization_city_id,
  CASE WHEN p.name LIKE '%1' AND p.city = 'City 1' THEN (SELECT min(id) FROM places WHERE name = 'Supplier#000000002' AND country = 'Country 16')
       WHEN (p.name LIKE '%3' OR p.name = 'Supplier#000000004') AND p.city <> 'City 13' THEN (SELECT min(id) FROM places WHERE name = 'Supplier#000000005') END AS parent_organization_id,
  p.upd_date
FROM places p LEFT JOIN countries c ON trim(c.country_name) = p.country
""")
def load_organizations(t: Tables):
    """Organizations of two loads and a seed, with parents by rule and places."""
    places = _organization_places(t, _landed(t))
    dims = [frame(t, n) for n in ("countries", "cities", "city_overrides")]
    return laureates.organizations(places, *dims, _ORG_RULES)


@query(common("laureates") + _ORGS + """,
  pairs AS (SELECT laureate_id, id, min(l.upd_date) AS since, max(l.upd_date) AS upd_date FROM laureates l
    JOIN places ON trim(organization_name) = name AND organization_country = country AND organization_city = city
    WHERE laureate_type = 'Individual' GROUP BY 1, 2),
  first AS (SELECT row_number() OVER (ORDER BY laureate_id, id) - 1 AS pid, * FROM pairs WHERE since = DATE '2024-01-07')
SELECT pid AS per_org_id, laureate_id, id AS organization_id, upd_date FROM first UNION ALL
SELECT (SELECT max(pid) FROM first) + row_number() OVER (ORDER BY laureate_id, id), laureate_id, id, upd_date FROM pairs WHERE since > DATE '2024-01-07'
""")
def load_persons_in_orgs(t: Tables):
    """The bridge over two loads."""
    rows = _landed(t)
    places = _organization_places(t, rows)
    before = materialize(laureates.persons_in_orgs(rows.where(FIRST), places, None), "persons-in-orgs")
    return laureates.persons_in_orgs(rows.where(SECOND), places, before)


@query(common("laureates") + f""",
  prizes AS (SELECT DISTINCT laureate_id, year, motivation, prize_share, category, laureate_type, prize, upd_date FROM laureates),
  numbered AS (SELECT *, row_number() OVER (ORDER BY prize) - 1 AS prize_type_id FROM prizes),
  cats AS (SELECT category, row_number() OVER (ORDER BY category) - 1 AS category_id FROM (SELECT DISTINCT category FROM laureates))
SELECT year, laureate_id, CAST(CASE laureate_type WHEN 'Individual' THEN 0 ELSE 1 END AS BIGINT) AS laureate_type_id, prize_type_id, prize_share, motivation,
       category_id, upd_date, (SELECT count(*) FROM prizes) AS n, CAST(0 AS BIGINT) AS lowest, (SELECT count(*) - 1 FROM prizes) AS highest
FROM numbered JOIN cats USING (category) WHERE {SECOND}
""")
def load_prizes(t: Tables):
    """A second load that repeats the first: only the new prizes are added, numbered on without a gap."""
    rows = _landed(t, *laureates.PRIZE_COLUMNS)
    dims = [reference.categories(rows, None), reference.prize_types(rows, None), reference.laureate_types(rows, None)]
    dims[1] = dims[1].drop("upd_date")
    before = materialize(laureates.nobel_prizes(rows.where(FIRST), *dims, None), "prizes")
    new = laureates.nobel_prizes(rows, *dims, before)
    numbers = before.select("nobel_prize_id").union(new.select("nobel_prize_id"))
    totals = {
        "n": F.count_distinct("nobel_prize_id"), "lowest": F.min("nobel_prize_id"), "highest": F.max("nobel_prize_id"),
    }
    return new.drop("nobel_prize_id").withColumns({name: numbers.agg(a).scalar() for name, a in totals.items()})


@query(common("laureates") + """,
  prizes AS (SELECT laureate_id, prize, min(year) AS year FROM laureates GROUP BY 1, 2)
SELECT row_number() OVER (ORDER BY year, laureate_id, prize) - 1 AS place, year, laureate_id, DATE '2024-01-14' AS upd_date FROM prizes
""")
def load_prizes_both_batches(t: Tables):
    """Two pending batches that repeat each other, in one run: one fact per prize, the newest."""
    rows = _landed(t, *laureates.PRIZE_COLUMNS)
    dims = [reference.categories(rows, None), reference.prize_types(rows, None).drop("upd_date"), reference.laureate_types(rows, None)]
    both = sinks.stamp(rows.drop("upd_date"), date(2024, 1, 7)).unionByName(sinks.stamp(rows.drop("upd_date"), date(2024, 1, 14)))
    new = laureates.nobel_prizes(both, *dims, None)
    named = new.join(dims[1], "prize_type_id")
    return keys.dense_id(named.select("year", "laureate_id", "prize_type", "upd_date"), ["year", "laureate_id", "prize_type"], "place").drop("prize_type")


_PEOPLE = "SELECT c_custkey AS laureate_id, c_name AS full_name, DATE '1900-01-01' AS birth_date, {city} AS birth_city_id, {country} AS birth_country_id, {city2} AS death_city_id, {country2} AS death_country_id, DATE '2024-01-07' AS upd_date FROM {{customer}} WHERE c_mktsegment <> 'BUILDING'".format(
    city="CASE WHEN c_custkey % 6 <> 0 THEN c_custkey END", country="CAST(CASE WHEN c_nationkey % 5 <> 4 AND c_custkey % 4 = 0 THEN 1000 + c_nationkey ELSE c_nationkey END AS BIGINT)",
    city2="CASE WHEN c_custkey % 3 = 0 THEN c_custkey + 1 END", country2="CASE WHEN c_custkey % 3 = 0 THEN CAST(3 AS BIGINT) END",
)
_PLACES = "SELECT s_suppkey AS organization_id, s_name AS organization_name, concat('Country ', CAST(s_nationkey AS STRING)) AS organization_country, concat('City ', CAST(s_suppkey % 50 AS STRING)) AS organization_city, DATE '2024-01-07' AS upd_date FROM {supplier}"
_WORKPLACES = "SELECT s_suppkey AS organization_id, s_name AS organization_name, CAST(s_nationkey AS BIGINT) AS organization_country_id, s_suppkey + 2 AS organization_city_id, CASE WHEN s_suppkey >= 4 THEN s_suppkey % 4 END AS parent_organization_id FROM {supplier}"


def _dataset_slot(i: int) -> str:
    return f"""
  o{i}.organization_name AS organization_name{i}, coalesce(q{i}.organization_name, o{i}.organization_name) AS organization_parent_name{i},
  o{i}.organization_city AS organization_city_name{i}, y{i}.city_region AS organization_city_region{i}, y{i}.population AS organization_city_population{i},
  o{i}.organization_country AS organization_country_name{i}, o{i}.organization_country AS organization_country_parent_name{i},
  g{i}.region_name AS organization_region_name{i}, g{i}.continent_name AS organization_continent_name{i}, g{i}.gdb_dollar_per_capita AS organization_country_gdb{i}"""


def _dataset_slot_joins(i: int) -> str:
    return f"""
LEFT JOIN slots n{i} ON n{i}.laureate_id = k.laureate_id AND n{i}.prize = k.prize AND n{i}.i = {i}
LEFT JOIN places o{i} ON o{i}.organization_name = n{i}.name LEFT JOIN workplaces w{i} ON w{i}.organization_id = o{i}.organization_id
LEFT JOIN places q{i} ON q{i}.organization_id = w{i}.parent_organization_id LEFT JOIN cities y{i} ON y{i}.city_id = w{i}.organization_city_id
LEFT JOIN described g{i} ON g{i}.country_id = w{i}.organization_country_id"""


_DATASET_COLUMNS = [
    "laureate_id", "prize", "prize_share", "laureate_type", "motivation", "laureate_person_name", "laureate_gender", "society_name",
    "birth_date", "birth_city_name", "birth_city_region", "birth_city_population", "birth_country_name",
    "birth_country_parent_name", "birth_region_name", "birth_continent_name", "birth_country_population", "birth_country_gdb",
    "death_date", "death_city_name", "death_city_region", "death_country_name", "death_country_parent_name",
    "death_continent_name", "death_country_gdb",
    *[f"organization_{c}{i}" for i in (1, 2, 3) for c in (
        "name", "parent_name", "city_name", "city_region", "city_population", "country_name", "country_parent_name",
        "region_name", "continent_name", "country_gdb")],
    "year", "category", "upd_date",
]


@query(common("laureates", "countries", "cities", "regions", "continents") + f""",
  people AS ({_PEOPLE.format(customer="customer")}), places AS ({_PLACES.format(supplier="supplier")}), workplaces AS ({_WORKPLACES.format(supplier="supplier")}),
  described AS (SELECT c.country_id, p.country_name AS parent_name, t.population, t.gdb_dollar_per_capita, region_name, continent_name
    FROM countries c LEFT JOIN countries p ON p.country_id = c.parent_country_id
    JOIN countries t ON t.country_id = coalesce(c.parent_country_id, c.country_id)
    LEFT JOIN regions r ON r.region_id = t.region_id LEFT JOIN continents k ON k.continent_id = t.continent_id),
  k AS (SELECT laureate_id, prize, min(year) AS year, min(category) AS category, min(prize_share) AS prize_share, min(laureate_type) AS laureate_type,
      min(motivation) AS motivation, min(full_name) AS full_name, min(gender) AS gender, min(birth_date) AS birth_date, min(birth_city) AS birth_city,
      min(birth_country) AS birth_country, min(death_date) AS death_date, min(death_city) AS death_city, min(death_country) AS death_country, max(upd_date) AS upd_date
    FROM laureates GROUP BY 1, 2),
  slots AS (SELECT *, row_number() OVER (PARTITION BY laureate_id, prize ORDER BY name) AS i FROM
    (SELECT DISTINCT laureate_id, prize, trim(organization_name) AS name FROM laureates WHERE organization_name IS NOT NULL))
SELECT k.laureate_id, k.prize, prize_share, laureate_type, motivation, CASE laureate_type WHEN 'Individual' THEN k.full_name END AS laureate_person_name,
  gender AS laureate_gender, CASE laureate_type WHEN 'Organization' THEN k.full_name END AS society_name, k.birth_date, birth_city AS birth_city_name,
  yb.city_region AS birth_city_region, yb.population AS birth_city_population, birth_country AS birth_country_name,
  coalesce(gb.parent_name, birth_country) AS birth_country_parent_name, gb.region_name AS birth_region_name, gb.continent_name AS birth_continent_name,
  gb.population AS birth_country_population, gb.gdb_dollar_per_capita AS birth_country_gdb, death_date, death_city AS death_city_name,
  yd.city_region AS death_city_region, death_country AS death_country_name, coalesce(gd.parent_name, death_country) AS death_country_parent_name,
  gd.continent_name AS death_continent_name, gd.gdb_dollar_per_capita AS death_country_gdb,
  {",".join(_dataset_slot(i) for i in (1, 2, 3))}, k.year, k.category, k.upd_date
FROM k LEFT JOIN people p ON p.laureate_id = k.laureate_id LEFT JOIN cities yb ON yb.city_id = p.birth_city_id LEFT JOIN cities yd ON yd.city_id = p.death_city_id
LEFT JOIN described gb ON gb.country_id = p.birth_country_id LEFT JOIN described gd ON gd.country_id = p.death_country_id
{"".join(_dataset_slot_joins(i) for i in (1, 2, 3))}
""")
def load_dataset(t: Tables):
    """The wide table: one row per laureate and prize, three organizations side by side."""
    countries = frame(t, "countries")
    for measure in schemas.COUNTRY_MEASURES:
        if measure not in countries.columns:
            countries = countries.withColumn(measure, F.lit(None).cast("int"))
    persons = t.spark.sql(_PEOPLE, customer=t.customer)
    places, workplaces = (t.spark.sql(text, supplier=t.supplier) for text in (_PLACES, _WORKPLACES))
    return wide.dataset(
        _landed(t), persons, places, workplaces, countries, frame(t, "cities"), frame(t, "regions"), frame(t, "continents")
    ).select(*_DATASET_COLUMNS)
