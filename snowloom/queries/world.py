"""The sources of the warehouse, derived from the given tables: orders are prizes, customers laureates and
cities, suppliers organizations, nations countries. The text runs in Spark and in the checking database."""

from __future__ import annotations

from pyspark.sql import DataFrame

from snowloom.queries.registry import Tables

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

WORLD = {
    # One row per prize and organization. Some laureates are societies, some persons work nowhere.
    "laureates": """
        SELECT CAST(year(o_orderdate) AS INT) AS year, o_orderpriority AS category, concat('Prize ', CAST(o_orderkey AS STRING)) AS prize,
          concat('For ', o_orderstatus) AS motivation, '1/1' AS prize_share, o_custkey AS laureate_id,
          CASE WHEN c_mktsegment = 'BUILDING' THEN 'Organization' ELSE 'Individual' END AS laureate_type, c_name AS full_name,
          DATE '1900-01-01' + CAST(c_custkey % 20000 AS INT) AS birth_date,
          concat('City ', CAST(c_custkey % 50 AS STRING), ' ') AS birth_city,
          concat(CASE WHEN c_custkey % 4 = 0 THEN 'Old Country ' ELSE 'Country ' END, CAST(c_nationkey AS STRING)) AS birth_country,
          CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN o_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
          CASE WHEN o_custkey % 7 = 3 THEN NULL ELSE concat(' ', s_name) END AS organization_name,
          CASE WHEN o_custkey % 7 = 3 THEN NULL ELSE concat('City ', CAST(s_suppkey % 50 AS STRING)) END AS organization_city,
          CASE WHEN o_custkey % 7 = 3 THEN NULL ELSE concat('Country ', CAST(s_nationkey AS STRING)) END AS organization_country,
          CASE WHEN o_custkey % 3 = 0 THEN DATE '1990-01-01' END AS death_date,
          CASE WHEN o_custkey % 3 = 0 THEN concat('City ', CAST(c_custkey % 70 AS STRING)) END AS death_city,
          CASE WHEN o_custkey % 3 = 0 THEN 'Country 3' END AS death_country,
          CASE WHEN CAST(o_orderdate AS DATE) < DATE '1998-04-01' THEN DATE '2024-01-07' ELSE DATE '2024-01-14' END AS upd_date
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {lineitem} ON l_orderkey = o_orderkey
        JOIN {supplier} ON s_suppkey = l_suppkey""",
    # Nations, and for each an older one whose parent it is.
    "countries": """
        SELECT CAST(n_nationkey AS BIGINT) AS country_id, concat('Country ', CAST(n_nationkey AS STRING), '  ') AS country_name,
          CAST(n_regionkey AS BIGINT) AS region_id, CAST(n_regionkey % 3 AS BIGINT) AS continent_id,
          CAST(NULL AS BIGINT) AS parent_country_id, n_nationkey * 1000 AS population, n_nationkey * 7 AS gdb_dollar_per_capita
        FROM {nation} UNION ALL
        SELECT 1000 + n_nationkey, concat('Old Country ', CAST(n_nationkey AS STRING)), NULL, NULL, CAST(n_nationkey AS BIGINT), NULL, NULL
        FROM {nation} WHERE n_regionkey <> 4""",
    # Several cities share a label and a country.
    "cities": """
        SELECT c_custkey AS city_id, concat('City ', CAST(c_custkey % 60 AS STRING)) AS city_label,
          CAST(c_nationkey AS BIGINT) AS country_id, c_mktsegment AS city_region, CAST(floor(c_acctbal) AS INT) AS population,
          CAST(c_custkey % 90 AS DECIMAL(20,17)) AS latitude, CAST(c_nationkey AS DECIMAL(20,17)) AS longitude
        FROM {customer}""",
    "city_overrides": """
        SELECT concat('City ', CAST(s_suppkey % 80 AS STRING), '  ') AS mis_city_name, s_suppkey AS city_id FROM {supplier}""",
    "regions": "SELECT CAST(r_regionkey AS BIGINT) AS region_id, concat(r_name, ' ') AS region_name FROM {region}",
    "continents": """
        SELECT DISTINCT CAST(r_regionkey % 3 AS BIGINT) AS continent_id, concat('Continent ', CAST(r_regionkey % 3 AS STRING)) AS continent_name,
          concat('K', CAST(r_regionkey % 3 AS STRING)) AS continent_code FROM {region}""",
    # A code list: customers as countries, some without a row in the country list.
    "code_names": "SELECT concat('C', CAST(c_custkey AS STRING)) AS country_code, concat(c_name, ' ') AS country_name FROM {customer}",
    "listed": """
        SELECT concat(c_name, '  ') AS country_name, c_mktsegment AS region, CAST(floor(c_acctbal) AS INT) AS population,
          CAST(c_nationkey AS DECIMAL(4,2)) AS climate, DATE '2024-01-07' AS upd_date FROM {customer} WHERE c_acctbal > 300""",
}


def frame(t: Tables, name: str, *more: str) -> DataFrame:
    """The source, with more columns of the tables it is made of before its own."""
    text = WORLD[name].replace("SELECT ", "SELECT " + "".join(f"{c}, " for c in more), 1)
    return t.spark.sql(text, **{table: getattr(t, table) for table in BASE if "{" + table + "}" in WORLD[name]})


def common(*names: str) -> str:
    """The same sources as common table expressions."""
    parts = [f"{name} AS ({WORLD[name].format(**{table: table for table in BASE})})" for name in names]
    return "WITH " + ",\n".join(parts)
