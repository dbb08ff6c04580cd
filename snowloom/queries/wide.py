"""The flagship: one wide row per order, with slots, roles, parents and the newest event."""

from __future__ import annotations

from pyspark.sql import functions as F

from snowloom.operators import enrich, reshape, versioning
from snowloom.queries.registry import Tables, query

_SLOT = """
  s{i}.s_name AS seller_name{i}, s{i}.n_name AS seller_nation{i}, s{i}.r_name AS seller_region{i}"""

_WIDE_SQL = f"""
WITH places AS (SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
     sellers AS (SELECT s_suppkey, s_name, n_name, r_name FROM supplier LEFT JOIN places ON s_nationkey = n_nationkey),
     pairs AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem),
     numbered AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey) AS i FROM pairs),
     lines AS (SELECT l_orderkey, min(l_quantity) AS least_quantity, max(l_shipdate) AS last_shipped FROM lineitem GROUP BY 1),
     newest AS (SELECT user_id, event_type, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT o_orderkey, o_orderstatus, least_quantity, last_shipped, c.c_name AS buyer_name, b.n_name AS buyer_nation,
       b.r_name AS buyer_region, coalesce(p.c_name, c.c_name) AS buyer_parent_name, e.event_type AS last_event,
       e.ts AS last_event_at,{",".join(_SLOT.format(i=i) for i in (1, 2, 3))}
FROM orders LEFT JOIN lines ON lines.l_orderkey = o_orderkey LEFT JOIN customer c ON o_custkey = c.c_custkey
LEFT JOIN customer p ON p.c_custkey = CASE WHEN c.c_custkey >= 7 THEN c.c_custkey % 7 END
LEFT JOIN places b ON c.c_nationkey = b.n_nationkey
LEFT JOIN newest e ON e.user_id = o_custkey
{"".join(f"LEFT JOIN numbered n{i} ON n{i}.l_orderkey = o_orderkey AND n{i}.i = {i} LEFT JOIN sellers s{i} ON s{i}.s_suppkey = n{i}.l_suppkey " for i in (1, 2, 3))}
"""


@query(_WIDE_SQL)
def wide_orders(t: Tables):
    """Lines are reduced to one row per order before anything is joined to them."""
    places = enrich.lookup(t.nation, t.region, {"n_regionkey": "r_regionkey"}, ["r_name"])

    sellers = enrich.role_lookup(
        t.supplier, places, "s_nationkey", "n_nationkey", "seller_", {"n_name": "nation", "r_name": "region"}
    )
    pairs = t.lineitem.select("l_orderkey", "l_suppkey").distinct()
    first = reshape.first_rows(pairs, ["l_orderkey"], ["l_suppkey"], 3, "slot")
    first = enrich.lookup(
        first, sellers, {"l_suppkey": "s_suppkey"}, {"s_name": "seller_name", "seller_nation": "seller_nation", "seller_region": "seller_region"}
    )
    cols = ["seller_name", "seller_nation", "seller_region"]
    slotted = reshape.pivot_slots(first, ["l_orderkey"], "slot", cols, 3)
    lines = t.lineitem.select("l_orderkey", F.col("l_quantity").alias("least_quantity"), F.col("l_shipdate").alias("last_shipped"))
    lines = reshape.collapse(lines, ["l_orderkey"], ["least_quantity"], ["last_shipped"])

    parent = F.when(F.col("c_custkey") >= 7, F.col("c_custkey") % 7)
    buyers = enrich.with_parent(
        t.customer.withColumn("parent_id", parent), "c_custkey", "parent_id", {"c_name": "buyer_parent_name"}
    )
    buyers = enrich.role_lookup(
        buyers, places, "c_nationkey", "n_nationkey", "buyer_", {"n_name": "nation", "r_name": "region"}
    )
    events = t.events.select("user_id", "event_id", F.col("event_type").alias("last_event"), F.col("ts").alias("last_event_at"))
    newest = versioning.latest(events, ["user_id"], "last_event_at", tiebreak=["event_id"])
    buyers = enrich.lookup(buyers, newest, {"c_custkey": "user_id"}, ["last_event", "last_event_at"])

    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    orders = enrich.lookup(orders, lines, {"o_orderkey": "l_orderkey"}, ["least_quantity", "last_shipped"])
    slot_cols = [f"{c}{i}" for i in (1, 2, 3) for c in cols]
    orders = enrich.lookup(orders, slotted, {"o_orderkey": "l_orderkey"}, slot_cols)
    taken = {"c_name": "buyer_name"} | {
        c: c for c in ("buyer_nation", "buyer_region", "buyer_parent_name", "last_event", "last_event_at")
    }
    return enrich.lookup(orders, buyers, {"o_custkey": "c_custkey"}, taken).select(
        "o_orderkey", "o_orderstatus", "least_quantity", "last_shipped", *taken.values(), *slot_cols
    )
