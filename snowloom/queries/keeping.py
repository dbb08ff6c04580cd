"""Batches that come again, current tables kept up batch by batch, and batches that need not be read."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowloom import sinks
from snowloom.operators import versioning
from snowloom.plans import conforming, geography, schemas
from snowloom.queries.registry import Tables, query
from snowloom.session import scratch_folder
from snowloom.sources.checked import read_csv_checked, read_json_checked
from snowloom.sinks import Layout
from snowloom.streaming.ingest import land_stream

FIRST, SECOND, THIRD = date(2024, 1, 7), date(2024, 1, 14), date(2024, 1, 21)


def _database(t: Tables) -> str:
    name = f"keep_{uuid.uuid4().hex}"
    sinks.ensure_database(t.spark, name, scratch_folder(t.spark, "keeping"))
    return name


@query("""
SELECT c_name AS accent_city_name, CAST(CASE WHEN c_custkey % 3 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS BIGINT) AS country_id,
       c_mktsegment AS city_region, c_acctbal AS population, DATE '2024-01-14' AS upd_date
FROM customer WHERE c_custkey % 7 <> 0
UNION ALL
SELECT c_name, c_nationkey, c_mktsegment, c_acctbal, DATE '2024-01-07' FROM customer
""")
def load_cities_landed_again(t: Tables):
    """A list landed again: every third city has moved to another country, every seventh is gone. Each is there once a list."""
    pairs = t.nation.select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("iso2_code"), F.col("n_name").alias("country_name"),
        F.col("n_nationkey").cast("long").alias("country_id"),
    )
    table, ids = f"{_database(t)}.cities", None

    def listed(day: date, where: str, nation: str) -> DataFrame:
        rows = t.customer.where(where).select(
            F.lower("c_name").alias("city_name"), F.col("c_name").alias("accent_city_name"), F.col("c_mktsegment").alias("city_region"),
            F.col("c_acctbal").alias("population"), F.lit(1).cast("decimal(20,17)").alias("latitude"),
            F.lit(1).cast("decimal(20,17)").alias("longitude"), F.concat(F.lit("n"), F.expr(nation).cast("string")).alias("country_code"),
        )
        return sinks.stamp(conforming.conform_cities(rows), day)

    moved = "CASE WHEN c_custkey % 3 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END"
    for day, where, nation in [(FIRST, "true", "c_nationkey"), (SECOND, "true", "c_nationkey"), (SECOND, "c_custkey % 7 <> 0", moved)]:
        rows = geography.cities(listed(day, where, nation), pairs, ids).drop("city_label", "country_code")
        sinks.replace_slice(rows, table, schemas.LAYOUTS["cities"], {"upd_date": day})
        ids = t.spark.table(table)
    return ids.select("accent_city_name", "country_id", "city_region", "population", "upd_date")


_VISITS = "SELECT user_id AS user_key, CAST(floor(value) AS BIGINT) % 7 AS state, event_id, CAST(ts AS DATE) AS day FROM {events}"
# Three loads and two repeats: a week, the next one, one before both, the second again with other rows, an older day.
_LOADS = [("2024-01-14", 8, 14, 1), ("2024-01-21", 15, 21, 1), ("2024-01-07", 1, 7, 1), ("2024-01-21", 15, 21, 3), ("2024-01-28", 22, 31, 2)]


@query("""
WITH v AS (SELECT user_id AS user_key, event_id, CASE WHEN day(ts) < 8 THEN DATE '2024-01-07' WHEN day(ts) < 15 THEN DATE '2024-01-14'
                  WHEN day(ts) < 22 THEN DATE '2024-01-21' ELSE DATE '2024-01-28' END AS upd_date FROM events
           WHERE CASE WHEN day(ts) < 15 THEN true WHEN day(ts) < 22 THEN event_id % 3 = 0 ELSE event_id % 2 = 0 END),
  top AS (SELECT user_key, max(upd_date) AS upd_date FROM v GROUP BY 1)
SELECT user_key, upd_date, max(event_id) AS event_id FROM v JOIN top USING (user_key, upd_date) GROUP BY 1, 2
""")
def current_by_merges(t: Tables):
    """Loads in any order, one late and one landed again with fewer rows: the table is what the newest of all of them give."""
    return _merged(t, "one")


@query("""
WITH v AS (SELECT user_id AS user_key, event_id, CASE WHEN day(ts) < 8 THEN DATE '2024-01-07' WHEN day(ts) < 15 THEN DATE '2024-01-14'
                  WHEN day(ts) < 22 THEN DATE '2024-01-21' ELSE DATE '2024-01-28' END AS upd_date FROM events
           WHERE CASE WHEN day(ts) < 15 THEN true WHEN day(ts) < 22 THEN event_id % 3 = 0 ELSE event_id % 2 = 0 END),
  top AS (SELECT user_key, max(upd_date) AS upd_date FROM v GROUP BY 1)
SELECT user_key, upd_date, event_id FROM v JOIN top USING (user_key, upd_date)
""")
def current_by_merges_all_ties(t: Tables):
    """The same where every row of a key's newest load stays."""
    return _merged(t, "all")


def _merged(t: Tables, ties: str) -> DataFrame:
    database = _database(t)
    table, history = f"{database}.users", f"{database}.history"
    events = t.events.select(F.col("user_id").alias("user_key"), "event_id", F.dayofmonth("ts").alias("day"))
    for label, first, last, every in _LOADS:
        day = date.fromisoformat(label)
        rows = events.where(F.col("day").between(first, last) & (F.col("event_id") % every == 0)).drop("day")
        sinks.replace_slice(sinks.stamp(rows, day), history, Layout(("upd_date",)), {"upd_date": day})
        batch = t.spark.table(history).where(F.col("upd_date") == day)
        options = {"tiebreak": ["event_id"]} if ties == "one" else {}
        sinks.merge(batch, table, ["user_key"], "upd_date", ties, layout=Layout((), 8, ("user_key",)), history=t.spark.table(history), **options)
    sinks.tidy(t.spark, table)
    return t.spark.table(table).select("user_key", "upd_date", "event_id")


@query("""
WITH o AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN DATE '2024-01-07' WHEN o_orderstatus = 'O' THEN DATE '2024-01-14' ELSE DATE '2024-01-21' END AS upd_date
           FROM orders WHERE o_orderstatus <> 'F' OR o_custkey % 2 = 0)
SELECT o_orderkey, o_custkey, o_totalprice, upd_date FROM o
WHERE o_custkey IN (SELECT o_custkey FROM o WHERE upd_date = DATE '2024-01-21' AND o_custkey % 2 = 1)
""")
def history_of_touched(t: Tables):
    """All rows of the keys of a batch, from those batches alone that hold any of them by the keys noted at landing."""
    table = f"{_database(t)}.orders"
    loads = [(FIRST, "o_orderstatus = 'F' AND o_custkey % 2 = 0"), (SECOND, "o_orderstatus = 'O'"), (THIRD, "o_orderstatus NOT IN ('F', 'O')")]
    for day, where in loads:
        sinks.land(t.orders.where(where).select("o_orderkey", "o_custkey", "o_totalprice"), table, day, index=["o_custkey"])
    landed = t.spark.table(table)
    touched = landed.where((F.col("upd_date") == THIRD) & (F.col("o_custkey") % 2 == 1)).select("o_custkey").distinct()
    within = t.spark.createDataFrame([(day,) for day, _ in loads], "upd_date date")
    found = sinks.holding(t.spark, table, touched, ["o_custkey"], within)
    return versioning.only_keys(sinks.batches(t.spark, table, found), touched, ["o_custkey"])


@query("""
SELECT o_orderkey, o_custkey, o_totalprice, DATE '2024-01-14' AS upd_date FROM orders WHERE o_custkey % 2 = 1
""")
def land_stream_pending(t: Tables):
    """Files streamed into a landing table in two calls: after the first has been consumed, the second's are pending."""
    database, files, state = _database(t), scratch_folder(t.spark, "stream-files"), scratch_folder(t.spark, "stream-state")
    table, marks = f"{database}.orders", f"{database}.marks"
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    for day, rest in ((FIRST, 0), (SECOND, 1)):
        rows.where(F.col("o_custkey") % 2 == rest).write.mode("append").parquet(files)
        land_stream(t.spark, files, rows.schema, table, state, day, max_files=2)
        if day == FIRST:
            sinks.mark_consumed(sinks.pin(t.spark, table, marks), table, marks)
    return sinks.pending(t.spark, table, marks).drop("landing")


@query("""
SELECT o_custkey, count(*) AS n_orders, count(*) AS counted, max(CASE WHEN o_orderstatus = 'F' THEN DATE '2024-01-07' ELSE DATE '2024-01-14' END) AS upd_date
FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1
""")
def commit_of_racing_runs(t: Tables):
    """Three runs begin alike: one dies, one commits, one comes second. Both tables are those of the one that committed."""
    database = _database(t)

    def begin(where: str, day: date) -> sinks.Commit:
        run = sinks.Commit(t.spark, database)
        run.put("orders", sinks.stamp(t.orders.where(where).select("o_orderkey", "o_custkey"), day), "upd_date", day)
        run.publish("customers", run.frame("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders")))
        return run

    begin("o_orderstatus = 'F'", FIRST).commit()
    begin("o_orderstatus = 'P'", THIRD)
    second, late = begin("o_orderstatus = 'O'", SECOND), begin("o_orderstatus <> 'F'", SECOND)
    second.commit()
    try:
        late.commit()
    except sinks.Conflict:
        pass
    else:
        raise RuntimeError("two runs committed from one state")
    found = sinks.at(t.spark, database)
    orders = found.frame("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("counted"), F.max("upd_date").alias("upd_date"))
    return found.frame("customers").join(orders, "o_custkey", "full")


@query("""
SELECT 'row' AS kind, CAST(c_custkey AS BIGINT) AS c_custkey, c_name AS text, CAST(c_nationkey AS INTEGER) AS c_nationkey FROM customer WHERE c_custkey % 10 > 1
UNION ALL SELECT 'wrong number of fields', NULL, CASE c_custkey % 10 WHEN 0 THEN c_custkey || '|' || c_name ELSE c_custkey || '|' || c_name || '|' || c_nationkey || '|x' END, NULL
FROM customer WHERE c_custkey % 10 <= 1
UNION ALL SELECT 'header without c_name', NULL, 'Customer Key|Nation', NULL
""")
def csv_rejects(t: Tables):
    """Files with their columns in two orders and under several names, lines of too few and too many fields, a header without a column."""
    folder = scratch_folder(t.spark, "csv-rejects")

    def write(where: str, header: str, *columns: str) -> None:
        line = F.concat_ws("|", *[F.expr(c).cast("string") for c in columns]).alias(header)
        t.customer.where(where).select(line).write.mode("append").option("header", True).csv(folder)

    write("c_custkey % 10 = 0", "Customer Key|Name|Nation", "c_custkey", "c_name")
    write("c_custkey % 10 = 1", "Customer Key|Name|Nation", "c_custkey", "c_name", "c_nationkey", "'x'")
    write("c_custkey % 10 BETWEEN 2 AND 5", "Customer Key|Name|Nation", "c_custkey", "c_name", "c_nationkey")
    write("c_custkey % 10 > 5", "C_NATIONKEY|balance|c_name|c-custkey", "c_nationkey", "c_acctbal", "c_name", "c_custkey")
    t.nation.where("n_nationkey = 0").select(F.lit("1|2").alias("Customer Key|Nation")).write.mode("append").option("header", True).csv(folder)
    spellings = {"c_custkey": ["Customer Key"], "c_name": ["Name"], "c_nationkey": ["Nation"]}
    read = read_csv_checked(t.spark, folder, "c_custkey long, c_name string, c_nationkey int", spellings, separator="|")
    rows = read.rows.select(F.lit("row").alias("kind"), "c_custkey", F.col("c_name").alias("text"), "c_nationkey")
    nothing = F.lit(None)
    broken = read.rejects.select(F.col("reason").alias("kind"), nothing.cast("long").alias("c_custkey"), F.col("raw").alias("text"), nothing.cast("int").alias("c_nationkey"))
    return rows.unionByName(broken)


@query("""
SELECT 'row' AS kind, c_custkey, c_name AS text FROM customer WHERE c_custkey % 5 > 1
UNION ALL SELECT 'no object of these types', NULL, CASE c_custkey % 5 WHEN 0 THEN '{"c_custkey": ' || c_custkey || ', "c_name": ' ELSE '{"c_custkey":"k' || c_custkey || '"}' END
FROM customer WHERE c_custkey % 5 <= 1
""")
def json_rejects(t: Tables):
    """Lines that break off and lines whose value has another type, beside those that parse."""
    folder = scratch_folder(t.spark, "json-rejects")
    key = F.col("c_custkey").cast("string")
    line = (
        F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit('{"c_custkey": '), key, F.lit(', "c_name": ')))
        .when(F.col("c_custkey") % 5 == 1, F.concat(F.lit('{"c_custkey":"k'), key, F.lit('"}')))
        .otherwise(F.to_json(F.struct("c_custkey", "c_name")))
    )
    t.customer.select(line).write.text(folder)
    read = read_json_checked(t.spark, folder, "c_custkey long, c_name string")
    rows = read.rows.select(F.lit("row").alias("kind"), "c_custkey", F.col("c_name").alias("text"))
    return rows.unionByName(read.rejects.select(F.col("reason").alias("kind"), F.lit(None).cast("long").alias("c_custkey"), F.col("raw").alias("text")))
