"""Ids, latest versions, collapsing, slots, entities, unions and scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from snowloom.operators import keys, reshape, versioning
from snowloom.queries.registry import Tables, query


@query("""
SELECT row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS order_id, o_orderkey, o_totalprice FROM orders
""")
def dense_id(t: Tables):
    """Numbered from 0 by price, then key."""
    return keys.dense_id(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], "order_id")


@query("""
SELECT row_number() OVER (ORDER BY l_returnflag, l_linestatus) - 1 AS line_id, l_returnflag, l_linestatus FROM lineitem
""")
def dense_id_duplicates(t: Tables):
    """Rows of which nothing tells the copies apart, each with a number of its own."""
    return keys.dense_id(t.lineitem.select("l_returnflag", "l_linestatus"), ["l_returnflag", "l_linestatus"], "line_id")


@query("SELECT row_number() OVER (ORDER BY kind) - 1 AS kind_id, kind FROM (SELECT DISTINCT event_type || '/' || user_id AS kind FROM events)")
def distinct_value_ids(t: Tables):
    """Distinct values numbered in their own order."""
    kind = F.concat_ws("/", "event_type", F.col("user_id").cast("string"))
    return keys.dense_id(t.events.select(kind.alias("kind")).distinct(), ["kind"], "kind_id")


@query("""
SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_name) AS party_id, s_name FROM supplier
""")
def continue_id(t: Tables):
    """Numbering continues after the highest id of another table."""
    return keys.dense_id(t.supplier.select("s_name"), ["s_name"], "party_id", keys.next_id(t.customer, "c_custkey"))


@query("""
WITH known AS (SELECT c_mktsegment AS seg, c_nationkey AS nk, min(c_custkey) AS id FROM customer WHERE c_acctbal < 0 GROUP BY 1, 2),
     every AS (SELECT DISTINCT c_mktsegment AS seg, c_nationkey AS nk FROM customer),
     fresh AS (SELECT e.seg, e.nk FROM every e LEFT JOIN known k ON e.seg = k.seg AND e.nk = k.nk WHERE k.id IS NULL)
SELECT id AS group_id, seg, nk FROM known
UNION ALL SELECT (SELECT max(id) FROM known) + row_number() OVER (ORDER BY seg, nk), seg, nk FROM fresh
""")
def stable_ids(t: Tables):
    """Keys seen before keep their id, new ones get the next."""
    groups = t.customer.select(F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").alias("nk"))
    known = (
        t.customer.where("c_acctbal < 0")
        .groupBy(F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").alias("nk"))
        .agg(F.min("c_custkey").alias("group_id"))
    )
    return keys.stable_ids(groups.distinct(), known, ["seg", "nk"], "group_id")


@query("""
SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM events
QUALIFY rank() OVER (PARTITION BY user_id, event_type ORDER BY CAST(ts AS DATE) DESC) = 1
""")
def latest_all_ties(t: Tables):
    """All events of the last day of each user and type."""
    events = t.events.select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    return versioning.latest(events, ["user_id", "event_type"], "day", ties="all")


@query("""
SELECT event_id, user_id, event_type, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY CAST(ts AS DATE) DESC, event_id DESC) = 1
""")
def latest_one(t: Tables):
    """One event per user and type: of the last day, the highest id."""
    events = t.events.withColumn("day", F.to_date("ts"))
    return versioning.latest(events, ["user_id", "event_type"], "day", tiebreak=["event_id"]).select(
        "event_id", "user_id", "event_type", "ts", "value"
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate) = 1
""")
def one_per_key(t: Tables):
    """The first line of each order, every tie broken."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]
    lines = t.lineitem.select("l_orderkey", *order)
    first = lines.groupBy("l_orderkey").agg(F.min(F.struct(*order)).alias("first"))
    return first.select("l_orderkey", "first.*").drop("l_shipdate")


@query("""
WITH d AS (SELECT DISTINCT l_orderkey, l_suppkey, l_partkey FROM lineitem),
     r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey, l_partkey) AS i FROM d)
SELECT l_orderkey, min(CASE WHEN i = 1 THEN l_suppkey END) AS l_suppkey1, min(CASE WHEN i = 1 THEN l_partkey END) AS l_partkey1,
       min(CASE WHEN i = 2 THEN l_suppkey END) AS l_suppkey2, min(CASE WHEN i = 2 THEN l_partkey END) AS l_partkey2,
       min(CASE WHEN i = 3 THEN l_suppkey END) AS l_suppkey3, min(CASE WHEN i = 3 THEN l_partkey END) AS l_partkey3
FROM r GROUP BY l_orderkey
""")
def slot_pivot(t: Tables):
    """The first three suppliers and parts of each order as numbered columns."""
    lines = t.lineitem.select("l_orderkey", "l_suppkey", "l_partkey").distinct()
    return reshape.slots(lines, ["l_orderkey"], ["l_suppkey", "l_partkey"], ["l_suppkey", "l_partkey"], 3)


@query("""
SELECT l_orderkey, min(l_returnflag) AS l_returnflag, min(l_quantity) AS l_quantity, max(l_shipdate) AS l_shipdate
FROM lineitem GROUP BY l_orderkey
""")
def collapse_min_max(t: Tables):
    return reshape.collapse(t.lineitem, ["l_orderkey"], ["l_returnflag", "l_quantity"], ["l_shipdate"])


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey, l_linenumber, l_partkey) AS i FROM lineitem)
SELECT l_orderkey, min(l_returnflag) AS l_returnflag, max(l_shipdate) AS l_shipdate,
       min(CASE WHEN i = 1 THEN l_suppkey END) AS l_suppkey1, min(CASE WHEN i = 2 THEN l_suppkey END) AS l_suppkey2
FROM r GROUP BY l_orderkey
""")
def collapse_slots(t: Tables):
    """Collapsed columns over all lines next to the slots of the first two."""
    order = ["l_suppkey", "l_linenumber", "l_partkey"]
    return reshape.collapse_with_slots(
        t.lineitem, ["l_orderkey"], order, ["l_suppkey"], 2, ["l_returnflag"], ["l_shipdate"]
    )


@query("SELECT c_custkey, c_custkey + (SELECT max(s_suppkey) FROM supplier) + 1 AS shifted, (SELECT r_regionkey FROM region WHERE r_name = (SELECT min(r_name) FROM region)) AS first_region FROM customer")
def scalar_max(t: Tables):
    """A highest id and a looked-up value, used as scalars inside the plan."""
    low = t.region.agg(F.min_by("r_regionkey", "r_name")).scalar()
    shifted = F.col("c_custkey") + keys.next_id(t.supplier, "s_suppkey")
    return t.customer.select("c_custkey", shifted.alias("shifted"), low.alias("first_region"))


@query("""
SELECT row_number() OVER (ORDER BY o_custkey, l_partkey) - 1 AS pair_id, o_custkey, l_partkey
FROM (SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
""")
def bridge(t: Tables):
    """The pairs of customers and parts, with an id."""
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return reshape.bridge(lines, "o_custkey", "l_partkey", "pair_id")


@query("""
WITH b AS (SELECT row_number() OVER (ORDER BY p_brand) - 1 AS brand_id, p_brand FROM (SELECT DISTINCT p_brand FROM part)),
     k AS (SELECT row_number() OVER (ORDER BY p_type, p_size) - 1 AS kind_id, p_type, p_size FROM (SELECT DISTINCT p_type, p_size FROM part))
SELECT p_partkey, brand_id, kind_id FROM part JOIN b USING (p_brand) JOIN k USING (p_type, p_size)
""")
def normalise_entities(t: Tables):
    """Two dimensions split off, their ids in the fact."""
    fact, _ = reshape.normalise(
        t.part, {"brands": ("brand_id", ["p_brand"]), "kinds": ("kind_id", ["p_type", "p_size"])}
    )
    return fact.select("p_partkey", "brand_id", "kind_id")


@query("""
SELECT c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS role FROM customer
UNION ALL SELECT s_name, s_nationkey, NULL, 'seller' FROM supplier
UNION ALL SELECT 'Seed ' || n_name, n_nationkey, NULL, NULL FROM nation
""")
def union_by_name_pad(t: Tables):
    """Frames of different width stacked by name."""
    return versioning.union_all(
        [
            t.customer.select(
                F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment")
            ),
            t.supplier.select(
                F.lit("seller").alias("role"), F.col("s_nationkey").alias("nationkey"), F.col("s_name").alias("name")
            ),
            t.nation.select(F.concat(F.lit("Seed "), "n_name").alias("name"), F.col("n_nationkey").alias("nationkey")),
        ]
    ).select("name", "nationkey", "segment", "role")
