"""Sources, projections, conditional columns and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from snowloom.functions import joined_when
from snowloom.operators import conform, enrich
from snowloom.queries.registry import Tables, query
from snowloom.session import scratch_folder
from snowloom.sources import read_code_list, read_csv, seed


@query("""
SELECT o_orderkey AS order_id, CAST(o_custkey AS INTEGER) AS customer_id,
       CASE WHEN o_orderkey % 10 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END AS price,
       CAST(o_orderdate AS DATE) AS ordered_on,
       CAST(NULL AS INTEGER) AS priority_number
FROM orders
""")
def rename_cast(t: Tables):
    """Rename by a map; type texts, some of which do not fit."""
    text = t.orders.select(
        F.col("o_orderkey").cast("string").alias("Order Key"),
        F.col("o_custkey").cast("string").alias("Customer Key"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit("n/a"))
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("Total Price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Order Date"),
        F.col("o_orderpriority").alias("Priority"),
    )
    names = {
        "Order Key": "order_id",
        "Customer Key": "customer_id",
        "Total Price": "price",
        "Order Date": "ordered_on",
        "Priority": "priority_number",
    }
    types = "order_id long, customer_id int, price decimal(12,2), ordered_on date, priority_number int"
    typed = conform.cast_to(conform.rename(text, names), T.StructType.fromDDL(types))
    return typed.withColumn("price", F.col("price").cast("double"))


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       'a "quoted", ' || o_orderpriority AS note
FROM orders
""")
def csv_roundtrip(t: Tables):
    """Write quoted files, read them by a schema."""
    orders = t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"),
        F.concat(F.lit('a "quoted", '), "o_orderpriority").alias("note"),
    )
    path = scratch_folder(t.spark, "csv")
    heads = [F.col(c).alias(c.replace("_", " ").title()) for c in orders.columns]
    orders.select(*heads).write.option("header", True).option("quoteAll", True).csv(path)
    return read_csv(t.spark, path, orders.schema)


@query("SELECT CAST(c_custkey AS VARCHAR) AS country_code, c_name AS country_name FROM customer")
def json_codes(t: Tables):
    """Write JSON lines, read them as a code list."""
    path = scratch_folder(t.spark, "json")
    t.customer.select(F.col("c_custkey").cast("string").alias("country"), F.col("c_name").alias("name")).write.json(path)
    return read_code_list(t.spark, path, "name", "country_code", "country_name")


@query("""
SELECT c_custkey, n_name,
       CASE WHEN n_nationkey % 5 = 0 THEN NULL
            WHEN n_name = 'NATION_1' THEN 'Edge' WHEN n_name = 'NATION_5' THEN 'Never'
            WHEN n_name = 'NATION_7' THEN 'Mid' ELSE r_name END AS place
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def seed_override(t: Tables):
    """Replace a looked-up value for listed names; an empty one becomes null and stays so."""
    nations = enrich.lookup(t.nation, t.region, {"n_regionkey": "r_regionkey"}, {"r_name": "place"})
    blanked = F.when(F.col("n_nationkey") % 5 == 0, F.lit("")).otherwise(F.col("place"))
    customers = enrich.lookup(
        t.customer, nations.withColumn("place", blanked), {"c_nationkey": "n_nationkey"}, ["n_name", "place"]
    )
    listed = {"NATION_1": "Edge", "NATION_5": "Never", "NATION_7": "Mid"}
    return conform.override(customers, "n_name", "place", listed, empty_is_null=True).select(
        "c_custkey", "n_name", "place"
    )


@query("""
SELECT e.event_id, e.event_type, CASE e.event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 END AS weight
FROM events e
""")
def seed_rows(t: Tables):
    """Hand-written rows used as a dimension."""
    weights = seed(t.spark, [("click", 1), (" view ", 2)], "kind string, weight int")
    return enrich.lookup(t.events, weights, {"event_type": "kind"}, ["weight"]).select(
        "event_id", "event_type", "weight"
    )


@query("""
SELECT event_id, CASE event_type WHEN 'click' THEN 'press' WHEN 'view' THEN 'look'
  ELSE CASE WHEN event_id % 2 = 1 THEN event_type || '  ' ELSE event_type END END AS kind
FROM events
""")
def alias_remap(t: Tables):
    """Values equal to a listed one but for blanks are replaced, others keep even their blanks."""
    padded = F.when(F.col("event_id") % 2 == 1, F.concat("event_type", F.lit("  "))).otherwise(F.col("event_type"))
    events = t.events.select("event_id", padded.alias("kind"))
    return conform.remap(events, "kind", {"click": "press", "view": "look"})


@query("""
SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'F' THEN 'FINISHED' ELSE '' END AS label
FROM orders
""")
def decode_label(t: Tables):
    coded = t.orders.select("o_orderkey", "o_orderstatus")
    return conform.decode(coded, "o_orderstatus", "label", {"O": "OPEN", "F": "FINISHED"})


@query("""
SELECT p_partkey, b AS p_brand,
       CASE WHEN b = 'Brand#X' THEN 'SPECIAL' WHEN p_type = 'SMALL' AND p_size <= 10 THEN 'TINY' ELSE p_type END AS p_type
FROM (SELECT *, CASE WHEN p_size = 7 THEN 'Brand#X' WHEN p_size = 8 THEN NULL ELSE p_brand END AS b FROM part)
""")
def patch_rules(t: Tables):
    """The second column's rules see the first one corrected."""
    parts = t.part.withColumn("p_brand", F.when(F.col("p_size") != 8, F.col("p_brand")))
    rules = [
        ("p_brand", [(F.col("p_size") == 7, "Brand#X")]),
        (
            "p_type",
            [
                (F.col("p_brand") == "Brand#X", "SPECIAL"),
                ((F.col("p_type") == "SMALL") & (F.col("p_size") <= 10), "TINY"),
            ],
        ),
    ]
    return conform.patch(parts, rules).select("p_partkey", "p_brand", "p_type")


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' AND c_custkey % 9 <> 0
    THEN CASE WHEN c_acctbal <= 5000 THEN 'M_low' ELSE 'M_high' END ELSE c_mktsegment END AS code
FROM customer
""")
def threshold_split(t: Tables):
    """A null measure keeps the code."""
    measure = F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal"))
    customers = t.customer.select("c_custkey", F.col("c_mktsegment").alias("code"), measure.alias("m"))
    return conform.threshold_split(customers, "code", "MACHINERY", "m", 5000, "M_low", "M_high").drop("m")


@query("""
SELECT DISTINCT c_nationkey, CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 'GOODS' ELSE c_mktsegment END AS segment
FROM customer
""")
def merge_codes_distinct(t: Tables):
    codes = t.customer.select("c_nationkey", F.col("c_mktsegment").alias("segment"))
    return conform.merge_codes(codes, "segment", {"MACHINERY": "GOODS", "FURNITURE": "GOODS"})


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag,
       CASE WHEN l_returnflag = 'A' THEN l_linestatus END AS accepted_status,
       CASE WHEN l_returnflag = 'R' THEN l_linestatus END AS returned_status
FROM lineitem
""")
def type_split(t: Tables):
    split = conform.split_by_type(
        t.lineitem, "l_returnflag", "l_linestatus", {"A": "accepted_status", "R": "returned_status"}
    )
    return split.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "accepted_status", "returned_status"
    )


@query("""
SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN concat_ws(', ', c_name, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END)
                       ELSE c_name END AS place
FROM customer
""")
def cond_concat(t: Tables):
    """Joined text for one country only; a null part is left out."""
    customers = t.customer.withColumn("state", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")))
    place = joined_when(F.col("c_nationkey") == 3, ", ", ["c_name", "state"], "c_name")
    return customers.select("c_custkey", place.alias("place"))


@query("""
SELECT p_partkey, s FROM (SELECT p_partkey, p_size, nullif(p_type, 'SMALL') AS s, nullif(p_brand, 'Brand#1') AS b FROM part)
WHERE s != 'ECONOMY' AND b NOT IN ('Brand#2', 'Brand#3') AND p_size IS NOT NULL
""")
def null_logic(t: Tables):
    """Unequal and not-in drop nulls."""
    parts = t.part.select(
        "p_partkey", "p_size", F.nullif("p_type", F.lit("SMALL")).alias("s"), F.nullif("p_brand", F.lit("Brand#1")).alias("b")
    )
    kept = parts.where((F.col("s") != "ECONOMY") & ~F.col("b").isin("Brand#2", "Brand#3") & F.col("p_size").isNotNull())
    return kept.select("p_partkey", "s")


@query("""
SELECT p_partkey, p_name FROM part
WHERE (p_name LIKE 'small%' OR p_name LIKE '%bolt' OR p_name LIKE '%idg%') AND trim(p_type) <> 'ECONOMY'
""")
def like_filters(t: Tables):
    """Prefix, suffix and infix patterns, equality on trimmed text."""
    name = F.col("p_name")
    fits = name.like("small%") | name.like("%bolt") | name.like("%idg%")
    return t.part.where(fits & (F.trim("p_type") != "ECONOMY")).select("p_partkey", "p_name")
