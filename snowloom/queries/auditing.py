"""Audits of keys, references, nulls and types."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from snowloom.operators import quality, similar
from snowloom.queries.registry import Tables, query


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def audit_pk(t: Tables):
    return quality.audit_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size <= 40) GROUP BY 1, 2
""")
def audit_fk(t: Tables):
    """Parts that are not among the small ones, with the supplier as a second key."""
    known = t.lineitem.select("l_partkey", "l_suppkey").distinct()
    small = known.join(t.part.where("p_size <= 40"), F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    return quality.audit_fk(t.lineitem, ["l_partkey", "l_suppkey"], [(small, ["l_partkey", "l_suppkey"])])


@query("""
SELECT user_id, count(*) AS n FROM events
WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 2000) AND user_id NOT IN (SELECT s_suppkey FROM supplier)
GROUP BY 1
""")
def audit_fk_poly(t: Tables):
    """A key that may refer to either of two tables."""
    parents = [(t.customer.where("c_acctbal > 2000"), ["c_custkey"]), (t.supplier, ["s_suppkey"])]
    return quality.audit_fk(t.events, ["user_id"], parents)


@query("""
SELECT 'p_brand' AS column_name, count(*) FILTER (WHERE p_brand = 'Brand#1') AS nulls FROM part
UNION ALL SELECT 'p_size', count(*) FILTER (WHERE p_size > 30) FROM part
UNION ALL SELECT 'p_name', count(*) FILTER (WHERE p_name IS NULL) FROM part
""")
def audit_nulls(t: Tables):
    parts = t.part.select(
        F.nullif("p_brand", F.lit("Brand#1")).alias("p_brand"), F.when(F.col("p_size") <= 30, F.col("p_size")).alias("p_size"), "p_name"
    )
    return quality.audit_not_null(parts, ["p_brand", "p_size", "p_name"])


@query("""
SELECT 'price' AS column_name, count(*) FILTER (WHERE o_orderkey % 10 = 0 OR o_totalprice >= 100000) AS bad_casts,
       CAST(0 AS BIGINT) AS too_long FROM orders
UNION ALL SELECT 'priority', 0, count(*) FILTER (WHERE length(o_orderpriority) > 5) FROM orders
UNION ALL SELECT 'day', count(*) FILTER (WHERE o_orderkey % 7 = 0), 0 FROM orders
""")
def audit_cast(t: Tables):
    """Texts that do not fit a number, a length or a date."""
    text = t.orders.select(
        F.when(F.col("o_orderkey") % 10 == 0, F.lit("?")).otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("2024-13-01")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
    )
    schema = T.StructType.fromDDL("price decimal(7,2), priority string, day date")
    return quality.audit_cast(text, schema, {"priority": 5})


@query("""
SELECT 0 AS check, 'lineitem' AS table_name, 'unique' AS kind, 'l_orderkey,l_linenumber' AS column_names,
       '["' || l_orderkey || '","' || l_linenumber || '"]' AS key, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL
SELECT 1, 'lineitem', 'reference', 'l_partkey', '["' || l_partkey || '"]', count(*) FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40) GROUP BY l_partkey
UNION ALL
SELECT 2, 'events', 'reference', 'user_id', '["' || user_id || '"]', count(*) FROM events
WHERE user_id NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40) AND user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY user_id
UNION ALL
SELECT 3, 'part', 'required', 'p_partkey,p_brand', 'p_brand', count(*) FROM part WHERE p_size <= 40 AND p_brand = 'Brand#1' HAVING count(*) > 0
""")
def audit_tables(t: Tables):
    """Keys, references into one table and into either of two, and required columns: each table scanned once for all."""
    small = t.part.where("p_size <= 40").select("p_partkey", F.nullif("p_brand", F.lit("Brand#1")).alias("p_brand"))
    checks = [
        quality.Check("lineitem", "unique", ["l_orderkey", "l_linenumber"]),
        quality.Check("lineitem", "reference", ["l_partkey"], [("part", ["p_partkey"])]),
        quality.Check("events", "reference", ["user_id"], [("part", ["p_partkey"]), ("supplier", ["s_suppkey"])]),
        quality.Check("part", "required", ["p_partkey", "p_brand"]),
    ]
    return quality.audit_tables({"lineitem": t.lineitem, "events": t.events, "part": small, "supplier": t.supplier}, checks)


_TYPED = """CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN concat(substr(p_name, 1, 3), substr(p_name, 5)) WHEN 2 THEN concat('x', p_name)
 WHEN 3 THEN concat(substr(p_name, 1, 4), 'q', substr(p_name, 6)) ELSE substr(p_name, 1, CAST(p_partkey % 7 AS INT)) END"""


@query(f"""
WITH typed AS (SELECT DISTINCT {_TYPED} AS name FROM part WHERE p_partkey % 4 < 3),
  known AS (SELECT DISTINCT p_name AS candidate FROM part UNION SELECT DISTINCT substr(p_name, 1, CAST(p_partkey % 6 AS INT)) FROM part)
SELECT name, candidate, CAST(levenshtein(name, candidate) AS INTEGER) AS distance FROM typed, known WHERE levenshtein(name, candidate) <= 2
""")
def near_names(t: Tables):
    """Names with a letter lost, added or changed, and very short ones, against all known names."""
    typed = t.part.where("p_partkey % 4 < 3").select(F.expr(_TYPED).alias("name"))
    known = t.part.select("p_name").union(t.part.select(F.expr("substr(p_name, 1, CAST(p_partkey % 6 AS INT))")))
    return similar.near_names(typed, known, 2)
