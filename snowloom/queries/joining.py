"""Lookups, chains, fallbacks, parents, roles and rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from snowloom.operators import enrich, quality
from snowloom.operators.enrich import Candidate, ParentRule, Step
from snowloom.queries.registry import Tables, query


@query("SELECT c_custkey, c_name, n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON c_nationkey = n_nationkey")
def lookup_left(t: Tables):
    """Trimmed text keys; rows without a match stay."""
    code = F.concat(F.lit("  N"), F.col("n_nationkey").cast("string"), F.lit(" "))
    nations = t.nation.where("n_regionkey <> 2").withColumn("code", code)
    customers = t.customer.withColumn("code", F.concat(F.lit("N"), F.col("c_nationkey").cast("string"), F.lit("  ")))
    return enrich.lookup(customers, nations, "code", ["n_name"]).select("c_custkey", "c_name", "n_name")


@query("""
SELECT o_orderkey, c_name, n_name, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""")
def lookup_chain(t: Tables):
    """Order to customer to nation to region."""
    steps = [
        Step(t.customer, {"o_custkey": "c_custkey"}, ["c_name", "c_nationkey"]),
        Step(t.nation, {"c_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"]),
        Step(t.region, {"n_regionkey": "r_regionkey"}, ["r_name"]),
    ]
    return enrich.lookup_chain(t.orders, steps).select("o_orderkey", "c_name", "n_name", "r_name")


@query("""
SELECT l_suppkey, count(*) AS n, min(s_name) AS s_name, max(s_nationkey) AS s_nationkey
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_suppkey
""")
def lookup_salted(t: Tables):
    """A lookup whose heavy keys are spread over tasks explicitly, under an aggregate on the same key."""
    joined = enrich.lookup(
        t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber"),
        t.supplier, {"l_suppkey": "s_suppkey"}, ["s_name", "s_nationkey"], how="inner", salted=True,
    )
    return joined.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.min("s_name").alias("s_name"), F.max("s_nationkey").alias("s_nationkey")
    )


@query("""
SELECT l_orderkey, l_partkey, l_linenumber, c_name, p_name
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
WHERE o_orderstatus = 'F'
""")
def inner_chain(t: Tables):
    """Inner matches one after the other, the filter below the first."""
    finished = t.orders.where("o_orderstatus = 'F'")
    steps = [
        Step(finished, {"l_orderkey": "o_orderkey"}, ["o_custkey"], "inner"),
        Step(t.customer, {"o_custkey": "c_custkey"}, ["c_name"], "inner"),
        Step(t.part, {"l_partkey": "p_partkey"}, ["p_name"], "inner"),
    ]
    return enrich.lookup_chain(t.lineitem, steps).select("l_orderkey", "l_partkey", "l_linenumber", "c_name", "p_name")


@query("""
WITH seen AS (SELECT user_id, event_id % 7 + 1 AS line, CASE event_type WHEN 'click' THEN 'A' WHEN 'view' THEN 'N' ELSE 'R' END AS flag,
                min(event_id) AS event_id FROM events GROUP BY 1, 2, 3)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, event_id
FROM lineitem JOIN seen ON l_suppkey = user_id AND l_linenumber = line AND l_returnflag = flag
""")
def inner_composite(t: Tables):
    """An inner match on three keys, one of them text with blanks; the lowest of several."""
    flag = F.when(F.col("event_type") == "click", "A ").when(F.col("event_type") == "view", " N").otherwise("R")
    events = t.events.select("event_id", "user_id", (F.col("event_id") % 7 + 1).alias("line"), flag.alias("flag"))
    on = {"l_suppkey": "user_id", "l_linenumber": "line", "l_returnflag": "flag"}
    return enrich.lookup(t.lineitem, events, on, ["event_id"], how="inner", lowest=True).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "event_id"
    )


@query("""
SELECT a.k AS part_ordered, b.k AS user_seen FROM (SELECT DISTINCT l_partkey * 2 AS k FROM lineitem) a
FULL OUTER JOIN (SELECT DISTINCT user_id * 3 AS k FROM events) b ON a.k = b.k
""")
def full_outer_codes(t: Tables):
    """Match two lists and keep what either has alone. Every sixth number may be in both."""
    return enrich.outer_match(
        t.lineitem.select((F.col("l_partkey") * 2).alias("part_ordered")),
        t.events.select((F.col("user_id") * 3).alias("user_seen")),
        {"part_ordered": "user_seen"}, ["part_ordered"], ["user_seen"],
    )


@query("""
SELECT p_partkey, p_name FROM part WHERE p_type NOT IN ('SMALL')
AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND year(l_shipdate) = 1998)
""")
def anti_missing(t: Tables):
    """Parts not shipped in one year, but for a listed type."""
    shipped = t.lineitem.where(F.year("l_shipdate") == 1998)
    lost = enrich.missing(t.part, shipped, {"p_partkey": "l_partkey"})
    return lost.where(~F.col("p_type").isin("SMALL")).select("p_partkey", "p_name")


@query("""
SELECT c_mktsegment AS name, count(*) AS n FROM customer
WHERE c_mktsegment NOT IN (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment < 'F') GROUP BY 1
""")
def unmatched_names(t: Tables):
    """Names a dimension does not know, with the number of rows."""
    padded = t.customer.select(F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")).alias("name"))
    known = t.customer.where("c_mktsegment < 'F'").select("c_mktsegment").distinct()
    return quality.unmatched(padded, known, "name", "c_mktsegment")


@query("""
SELECT s_suppkey, c_custkey FROM supplier LEFT JOIN customer ON s_nationkey = c_nationkey
AND substr(s_name, 10) = substr(c_name, 10)
""")
def lookup_two_key(t: Tables):
    """Trimmed text and a raw id."""
    suppliers = t.supplier.withColumn("tag", F.concat(F.expr("substr(s_name, 10)"), F.lit("  ")))
    customers = t.customer.withColumn("tag", F.expr("substr(c_name, 10)"))
    on = {"tag": "tag", "s_nationkey": "c_nationkey"}
    return enrich.lookup(suppliers, customers, on, ["c_custkey"]).select("s_suppkey", "c_custkey")


@query("""
SELECT p.p_partkey, q.twin FROM part p LEFT JOIN (SELECT p_brand, p_type, p_name, min(p_partkey) AS twin FROM part WHERE p_size > 10 GROUP BY 1, 2, 3) q
ON p.p_brand = q.p_brand AND p.p_type = q.p_type AND p.p_name = q.p_name
""")
def lookup_three_key(t: Tables):
    """Three text keys with blanks; of several matches the lowest id, of parts of another size none."""
    blank = [F.concat(F.lit(" "), c).alias(c) for c in ("p_brand", "p_type", "p_name")]
    listed = t.part.where("p_size > 10").select("p_partkey", *blank)
    return enrich.lookup(
        t.part, listed, ["p_brand", "p_type", "p_name"], {"p_partkey": "twin"}, lowest=True
    ).select("p_partkey", "twin")


@query("""
WITH band AS (SELECT s_nationkey AS nk, CAST(floor(s_acctbal / 1000) AS BIGINT) AS b, min(s_suppkey) AS id FROM supplier GROUP BY 1, 2),
     nat AS (SELECT s_nationkey AS nk, min(s_suppkey) AS id FROM supplier WHERE s_acctbal > 5000 GROUP BY 1),
     reg AS (SELECT n_regionkey AS rk, min(s_suppkey) AS id FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)
SELECT c_custkey, coalesce(band.id, nat.id, reg.id) AS supplier_id
FROM customer JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN band ON band.nk = c_nationkey AND band.b = CAST(floor(c_acctbal / 1000) AS BIGINT)
LEFT JOIN nat ON nat.nk = c_nationkey LEFT JOIN reg ON reg.rk = n_regionkey
""")
def fallback_chain(t: Tables):
    """A supplier of the same nation and balance band, else a rich one of the nation, else one of the region."""
    suppliers = enrich.lookup(t.supplier, t.nation, {"s_nationkey": "n_nationkey"}, ["n_regionkey"])
    suppliers = suppliers.withColumn("band", F.floor(F.col("s_acctbal") / 1000))
    customers = enrich.lookup(t.customer, t.nation, {"c_nationkey": "n_nationkey"}, {"n_regionkey": "rk"})
    customers = customers.withColumn("b", F.floor(F.col("c_acctbal") / 1000))
    ways = [
        Candidate(suppliers, {"c_nationkey": "s_nationkey", "b": "band"}, "s_suppkey"),
        Candidate(suppliers.where("s_acctbal > 5000"), {"c_nationkey": "s_nationkey"}, "s_suppkey"),
        Candidate(suppliers, {"rk": "n_regionkey"}, "s_suppkey"),
    ]
    return enrich.first_match(customers, ways, "supplier_id").select("c_custkey", "supplier_id")


@query("""
SELECT c.c_custkey, CASE WHEN c.c_custkey >= 7 THEN c.c_custkey % 7 END AS parent_id,
       coalesce(p.c_name, c.c_name) AS parent_name, coalesce(p.c_acctbal, c.c_acctbal) AS parent_balance
FROM customer c LEFT JOIN customer p ON p.c_custkey = CASE WHEN c.c_custkey >= 7 THEN c.c_custkey % 7 END
""")
def parent_self_join(t: Tables):
    """Attributes of the parent, of the row itself when it has none. Seven parents hold all rows."""
    parent = F.when(F.col("c_custkey") >= 7, F.col("c_custkey") % 7)
    children = t.customer.withColumn("parent_id", parent)
    return enrich.with_parent(
        children, "c_custkey", "parent_id", {"c_name": "parent_name", "c_acctbal": "parent_balance"}
    ).select("c_custkey", "parent_id", "parent_name", "parent_balance")


@query("""
WITH places AS (SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)
SELECT b.n_name AS buyer_nation, b.r_name AS buyer_region, s.n_name AS seller_nation, s.r_name AS seller_region, count(*) AS n
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN places b ON c_nationkey = b.n_nationkey LEFT JOIN places s ON s_nationkey = s.n_nationkey
GROUP BY ALL
""")
def role_dims(t: Tables):
    """One pre-joined dimension in two roles."""
    places = enrich.lookup(t.nation, t.region, {"n_regionkey": "r_regionkey"}, ["r_name"])
    lines = enrich.lookup(t.lineitem, t.orders, {"l_orderkey": "o_orderkey"}, ["o_custkey"])
    lines = enrich.lookup(lines, t.customer, {"o_custkey": "c_custkey"}, ["c_nationkey"])
    lines = enrich.lookup(lines, t.supplier, {"l_suppkey": "s_suppkey"}, ["s_nationkey"])
    # The roles depend on the two nation keys alone, so rows are counted per pair before the roles are added.
    pairs = lines.groupBy("c_nationkey", "s_nationkey").agg(F.count(F.lit(1)).alias("k"))
    names = {"n_name": "nation", "r_name": "region"}
    pairs = enrich.role_lookup(pairs, places, "c_nationkey", "n_nationkey", "buyer_", names)
    pairs = enrich.role_lookup(pairs, places, "s_nationkey", "n_nationkey", "seller_", names)
    return pairs.groupBy("buyer_nation", "buyer_region", "seller_nation", "seller_region").agg(F.sum("k").alias("n"))


_NAME_RULES = [
    ParentRule({"p_name": ["%red%", "blue %"]}, {"p_name": "red widget"}),
    ParentRule({"p_name": ["small%"]}, {"p_name": "small ring"}),
    ParentRule({"p_name": ["%bolt"]}, {"p_name": "blue bolt"}),
    ParentRule({"p_name": ["%ring"]}, {"p_name": "no such part"}),
]


@query("""
SELECT p_partkey, p_name, CASE
  WHEN p_name LIKE '%red%' OR p_name LIKE 'blue %' THEN (SELECT min(p_partkey) FROM part WHERE p_name = 'red widget')
  WHEN p_name LIKE 'small%' THEN (SELECT min(p_partkey) FROM part WHERE p_name = 'small ring')
  WHEN p_name LIKE '%bolt' THEN (SELECT min(p_partkey) FROM part WHERE p_name = 'blue bolt') END AS parent_id
FROM part
""")
def rule_parent_simple(t: Tables):
    """Ordered patterns on one name; the first that fits names the parent."""
    return enrich.resolve_parent(t.part, _NAME_RULES, t.part, "p_partkey", "parent_id").select(
        "p_partkey", "p_name", "parent_id"
    )


_PLACE_RULES = [
    ParentRule({"p_brand": ["Brand#1"], "p_type": ["SMALL"]}, {"p_brand": "Brand#1", "p_type": "ECONOMY"}),
    ParentRule({"p_brand": ["Brand#1%"]}, {"p_brand": "Brand#2"}, unless={"p_type": ["ECONOMY", "LARGE%"]}),
    ParentRule({"p_name": ["%widget"]}, {"p_brand": "Brand#3", "p_name": "red widget"}),
    ParentRule({"p_brand": ["Brand#4"]}, {"p_type": "PROMO"}),
    ParentRule({"p_brand": ["Brand#5"]}, {"p_name": "old bolt"}),
]


@query("""
SELECT p_partkey, CASE
  WHEN p_brand = 'Brand#1' AND p_type = 'SMALL' THEN (SELECT min(p_partkey) FROM part WHERE p_brand = 'Brand#1' AND p_type = 'ECONOMY')
  WHEN p_brand LIKE 'Brand#1%' AND NOT (p_type = 'ECONOMY' OR p_type LIKE 'LARGE%') THEN (SELECT min(p_partkey) FROM part WHERE p_brand = 'Brand#2')
  WHEN p_name LIKE '%widget' THEN (SELECT min(p_partkey) FROM part WHERE p_brand = 'Brand#3' AND p_name = 'red widget')
  WHEN p_brand = 'Brand#4' THEN (SELECT min(p_partkey) FROM part WHERE p_type = 'PROMO')
  WHEN p_brand = 'Brand#5' THEN (SELECT min(p_partkey) FROM part WHERE p_name = 'old bolt') END AS parent_id
FROM part
""")
def rule_parent_multi(t: Tables):
    """Conditions and parents on several columns, one of them negated, each rule by columns of its own."""
    return enrich.resolve_parent(t.part, _PLACE_RULES, t.part, "p_partkey", "parent_id").select("p_partkey", "parent_id")


@query("""
WITH c AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 3 = 0 AND c_custkey < 5000 THEN c_custkey END AS whole,
                  CASE WHEN (c_custkey // 10) % 3 = 1 AND c_custkey // 10 < 5000 AND c_nationkey <> 7 THEN c_custkey // 10 END AS opening,
                  CASE WHEN c_custkey % 1000 % 3 = 2 AND c_mktsegment LIKE '%E%' THEN c_custkey % 1000 END AS ending FROM customer),
  r AS (SELECT *, least(whole, opening, ending) AS rule FROM c)
SELECT r.c_custkey, p.c_custkey AS parent_key FROM r LEFT JOIN customer p ON p.c_custkey = r.rule
""")
def rule_parent_indexed(t: Tables):
    """Five thousand rules, by whole names, beginnings and ends, some with a second column: the first that fits counts."""
    rules = []
    for i in range(5000):
        if i % 3 == 0:
            when, unless = {"c_name": [f"Customer#{i:09d}"]}, {}
        elif i % 3 == 1:
            when, unless = {"c_name": [f"Customer#{i:08d}%"]}, {"c_nation": ["7"]}
        else:
            when, unless = {"c_name": [f"%{i:03d}"] if i < 1000 else [f"%/{i}"], "c_mktsegment": ["%E%"]}, {}
        rules.append(ParentRule(when, {"c_name": f"Customer#{i:09d}"}, unless))
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment", F.col("c_nationkey").cast("string").alias("c_nation"))
    return enrich.resolve_parent_indexed(rows, rules, t.customer, "c_custkey", "parent_key").select("c_custkey", "parent_key")
