"""Sinks, layouts, batches and versions. Each query writes to a new place and gives what it reads back."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from snowloom import sinks, sources
from snowloom.operators import keys, versioning
from snowloom.queries.registry import Tables, query
from snowloom.session import scratch_folder
from snowloom.sinks import Layout
from snowloom.streaming import land_new_files, landed


def _database(t: Tables) -> str:
    name = f"db_{uuid.uuid4().hex}"
    sinks.ensure_database(t.spark, name, scratch_folder(t.spark, "database"))
    return name


_EARLY = "CAST(o_orderdate AS DATE) < DATE '1998-04-01'"


def _orders(t: Tables, where: str = "true"):
    return t.orders.where(where).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query(f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CASE WHEN {_EARLY} THEN DATE '2024-01-07' ELSE DATE '2024-01-14' END AS upd_date FROM orders
""")
def land_two_batches(t: Tables):
    table = f"{_database(t)}.orders"
    sinks.land(_orders(t, _EARLY), table, date(2024, 1, 7))
    sinks.land(_orders(t, f"NOT {_EARLY}"), table, date(2024, 1, 14))
    return t.spark.table(table)


@query(f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CASE WHEN {_EARLY} THEN DATE '2024-01-07' ELSE DATE '2024-01-14' END AS upd_date FROM orders
""")
def land_rerun(t: Tables):
    """A batch landed again replaces itself and nothing else."""
    table = f"{_database(t)}.orders"
    sinks.land(_orders(t, _EARLY), table, date(2024, 1, 7))
    sinks.land(_orders(t, f"NOT {_EARLY}"), table, date(2024, 1, 14))
    sinks.land(_orders(t, _EARLY), table, date(2024, 1, 7))
    return t.spark.table(table)


@query(f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, DATE '2024-01-14' AS upd_date FROM orders WHERE NOT {_EARLY}")
def pending_batches(t: Tables):
    """Only the batch after the consumed one is still to be read."""
    database = _database(t)
    table, marks = f"{database}.orders", f"{database}.marks"
    sinks.land(_orders(t, _EARLY), table, date(2024, 1, 7))
    sinks.mark_consumed(sinks.pin(t.spark, table, marks), table, marks)
    sinks.land(_orders(t, f"NOT {_EARLY}"), table, date(2024, 1, 14))
    return sinks.pending(t.spark, table, marks)


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CASE o_orderstatus WHEN 'O' THEN DATE '2024-01-03' WHEN 'F' THEN DATE '2024-01-14' ELSE DATE '2024-01-21' END AS upd_date,
       o_orderstatus = 'F' AS repeated FROM orders
""")
def pending_late_batch(t: Tables):
    """A batch older than those consumed, a consumed date landed again, and one that lands during a run."""
    database = _database(t)
    table, marks = f"{database}.orders", f"{database}.marks"
    sinks.land(_orders(t, "o_orderstatus = 'P'"), table, date(2024, 1, 14))
    first = sinks.pin(t.spark, table, marks)
    # These land while the first run works, so they are not its.
    sinks.land(_orders(t, "o_orderstatus NOT IN ('O', 'F')"), table, date(2024, 1, 21))
    sinks.land(_orders(t, "o_orderstatus = 'O'"), table, date(2024, 1, 3))
    sinks.mark_consumed(first, table, marks)
    sinks.land(_orders(t, "o_orderstatus = 'F'"), table, date(2024, 1, 14))
    second = sinks.pin(t.spark, table, marks)
    rows = sinks.batches(t.spark, table, second)
    again = first.select("upd_date", F.lit(True).alias("again"))
    marked = rows.join(again, "upd_date", "left")
    return marked.select(*rows.columns, F.coalesce("again", F.lit(False)).alias("repeated"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, DATE '2024-01-07' AS upd_date FROM orders")
def land_files_once(t: Tables):
    """A file stream that takes what is new and stops; the second run finds nothing new."""
    target, state = scratch_folder(t.spark, "landed"), scratch_folder(t.spark, "stream-state")
    schema = t.orders.schema
    for _ in range(2):
        land_new_files(
            t.spark, t.folder, schema, target, state, date(2024, 1, 7), options={"pathGlobFilter": "orders.parquet"}
        )
    return landed(t.spark, target, schema).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "upd_date")


@query("""
SELECT c_custkey, c_name, c_acctbal + v AS balance, CAST(DATE '2024-01-01' + CAST(v AS INTEGER) AS DATE) AS upd_date
FROM customer, (SELECT unnest([0, 1, 2]) AS v) WHERE v < 2 OR c_mktsegment <> 'MACHINERY'
""")
def snapshot_history(t: Tables):
    """Three full lists appended as partitions; the third lacks some rows."""
    return t.spark.table(_history(t))


def _history(t: Tables) -> str:
    table = f"{_database(t)}.customers"
    for v in range(3):
        rows = t.customer.where("c_mktsegment <> 'MACHINERY'") if v == 2 else t.customer
        rows = rows.select("c_custkey", "c_name", (F.col("c_acctbal") + v).alias("balance"))
        sinks.append(sinks.stamp(rows, date(2024, 1, 1 + v)), table, Layout(("upd_date",)))
    return table


@query("""
SELECT c_custkey, c_name, c_acctbal + CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 2 END AS balance,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN DATE '2024-01-02' ELSE DATE '2024-01-03' END AS upd_date FROM customer
""")
def current_view(t: Tables):
    """The newest version of each customer."""
    return sources.current(t.spark.table(_history(t)), ["c_custkey"], "upd_date")


_FIRST_HALF = "CAST(ts AS DATE) < DATE '2024-01-16'"


@query(f"""
SELECT kind AS user_key, CASE WHEN n2 > 0 THEN DATE '2024-02-01' ELSE DATE '2024-01-01' END AS upd_date,
       CASE WHEN n2 > 0 THEN v2 ELSE v1 END AS top_value
FROM (SELECT user_id AS kind, count(*) FILTER (WHERE NOT {_FIRST_HALF}) AS n2,
             max(value) FILTER (WHERE {_FIRST_HALF}) AS v1, max(value) FILTER (WHERE NOT {_FIRST_HALF}) AS v2
      FROM events GROUP BY 1)
""")
def upsert_latest(t: Tables):
    """Previous rows and a delta, the newest per key, written as a new version behind the view it reads."""
    table = f"{_database(t)}.users"
    layout = Layout(("upd_date",))

    def tops(events, day):
        return sinks.stamp(events.groupBy(F.col("user_id").alias("user_key")).agg(F.max("value").alias("top_value")), day)

    sinks.publish(tops(t.events.where(_FIRST_HALF), date(2024, 1, 1)), table, layout)
    delta = tops(t.events.where(f"NOT {_FIRST_HALF}"), date(2024, 2, 1))
    sinks.publish(versioning.upsert_latest(t.spark.table(table), delta, ["user_key"], "upd_date"), table, layout)
    return t.spark.table(table).select("user_key", "upd_date", "top_value")


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'O'
UNION ALL SELECT o_orderkey, o_custkey, 'X', o_totalprice FROM orders WHERE o_orderstatus = 'O'
""")
def append_guarded(t: Tables):
    """Keys already there are not added again."""
    table = f"{_database(t)}.facts"
    first = _orders(t, "o_orderstatus = 'O'").withColumn("o_orderstatus", F.lit("X"))
    sinks.append(first, table)
    sinks.append(versioning.append_guarded(t.spark.table(table), _orders(t), ["o_orderkey"]), table)
    return t.spark.table(table)


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus IN ('O', 'F') THEN 'new' ELSE o_orderpriority END AS o_orderpriority, o_totalprice FROM orders
""")
def replace_keys(t: Tables):
    """Rows of the touched keys exchanged, rows of new keys added, all others stay."""
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    prev = orders.where("o_orderstatus <> 'F'").drop("o_orderstatus")
    rebuilt = orders.where("o_orderstatus IN ('O', 'F')").drop("o_orderstatus").withColumn("o_orderpriority", F.lit("new"))
    return versioning.replace_keys(prev, rebuilt, ["o_orderkey"])


@query("""
SELECT l_suppkey, count(*) AS n, min(o_orderdate) AS first_order FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY l_suppkey
""")
def bucketed_read(t: Tables):
    """Two tables bucketed alike, joined on the bucket column."""
    database = _database(t)
    sinks.create_table(t.lineitem.select("l_orderkey", "l_suppkey"), f"{database}.lines", Layout((), 8, ("l_orderkey",)))
    sinks.create_table(t.orders.select("o_orderkey", "o_orderdate"), f"{database}.orders", Layout((), 8, ("o_orderkey",)))
    lines, orders = t.spark.table(f"{database}.lines"), t.spark.table(f"{database}.orders")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("first_order"))


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem WHERE l_returnflag <> 'A'
UNION ALL SELECT l_orderkey, l_partkey, -1, l_linenumber, l_returnflag, l_linestatus FROM lineitem WHERE l_returnflag = 'A'
""")
def dynamic_partitions(t: Tables):
    """Partitioned and bucketed table; the partitions of an insert are replaced, others stay."""
    table = f"{_database(t)}.lines"
    layout = Layout(("l_returnflag", "l_linestatus"), 4, ("l_orderkey",))
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")
    sinks.create_table(lines, table, layout)
    changed = lines.where("l_returnflag = 'A'").withColumn("l_suppkey", F.lit(-1).cast("long"))
    sinks.insert(changed, table, layout, overwrite=True)
    return t.spark.table(table)


@query("SELECT c_name, c_mktsegment, c_custkey, c_nationkey FROM customer")
def table_copy(t: Tables):
    """A table copied into another layout, its partition column last."""
    database = _database(t)
    sinks.create_table(t.customer.select("c_nationkey", "c_name", "c_mktsegment", "c_custkey"), f"{database}.a")
    layouts = {f"{database}.b": Layout(("c_nationkey",))}
    sinks.copy_tables(t.spark, {f"{database}.a": f"{database}.b"}, layouts)
    return sources.read_table(t.spark, f"{database}.b")


@query("""
SELECT 'customer' AS source, c_custkey AS key, CAST(c_nationkey AS VARCHAR) AS place FROM customer
UNION ALL SELECT 'orders', o_orderkey, o_orderstatus FROM orders UNION ALL SELECT 'nation', n_nationkey, n_name FROM nation
""")
def copy_warehouse(t: Tables):
    """A set of tables copied into another database, each in partitions and buckets of its own."""
    source, target = _database(t), _database(t)
    tables = {"customer": "c_custkey, c_nationkey", "orders": "o_orderkey, o_orderstatus", "nation": "n_nationkey, n_name"}
    for name, columns in tables.items():
        sinks.create_table(getattr(t, name).select(*columns.split(", ")), f"{source}.{name}")
    layouts = {
        f"{target}.customer": Layout(("c_nationkey",), 4, ("c_custkey",)), f"{target}.orders": Layout(("o_orderstatus",)),
    }
    sinks.copy_tables(t.spark, {f"{source}.{name}": f"{target}.{name}" for name in tables}, layouts)
    rows = []
    for name, columns in tables.items():
        key, place = columns.split(", ")
        copied = sources.read_table(t.spark, f"{target}.{name}")
        rows.append(copied.select(F.lit(name).alias("source"), F.col(key).cast("long").alias("key"), F.col(place).cast("string").alias("place")))
    return versioning.union_all(rows)


@query("""
WITH d AS (SELECT DISTINCT c_mktsegment AS seg, c_nationkey % 5 AS grp FROM customer),
     a AS (SELECT row_number() OVER (ORDER BY seg, grp) - 1 AS id, seg, grp FROM d WHERE grp < 3),
     b AS (SELECT (SELECT max(id) FROM a) + row_number() OVER (ORDER BY seg, grp) AS id, seg, grp FROM d WHERE grp >= 3)
SELECT id AS kind_id, seg, grp FROM a UNION ALL SELECT id, seg, grp FROM b
""")
def stable_ids_two_loads(t: Tables):
    """Ids given by a first load are found again by the second, which only adds."""
    table = f"{_database(t)}.kinds"
    kinds = t.customer.select(F.col("c_mktsegment").alias("seg"), (F.col("c_nationkey") % 5).alias("grp")).distinct()
    sinks.publish(keys.stable_ids(kinds.where("grp < 3"), None, ["seg", "grp"], "kind_id"), table)
    sinks.publish(keys.stable_ids(kinds, t.spark.table(table), ["seg", "grp"], "kind_id"), table)
    return t.spark.table(table)
