"""Time the headline queries and print one JSON line.

Every query is run once to warm up and then ``BENCH_REPEAT`` times (default 2) in full, its rows going to
Spark's ``noop`` sink; the median counts. ``plain`` holds the same work written the direct way, one window
or one step after the other, for comparison.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snowloom.queries import QUERIES
from snowloom.queries.joining import _NAME_RULES

HEADLINE = [
    "wide_orders", "load_dataset", "dense_id", "stable_ids", "rule_parent_simple", "slot_pivot", "collapse_slots",
    "fallback_chain", "latest_one", "latest_all_ties", "one_per_key", "lookup_chain", "lookup_salted", "role_dims",
    "parent_self_join", "inner_chain", "full_outer_codes", "anti_missing", "bridge", "normalise_entities",
    "alias_remap", "rename_cast", "csv_roundtrip", "land_two_batches", "land_rerun", "dynamic_partitions",
    "bucketed_read", "upsert_latest", "append_guarded", "audit_pk", "audit_fk", "audit_cast", "audit_nulls",
]


def plain_dense_id(spark: SparkSession, d: str) -> DataFrame:
    orders = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_totalprice")
    return orders.withColumn("order_id", F.row_number().over(W.orderBy("o_totalprice", "o_orderkey")) - 1)


def plain_rule_parent_simple(spark: SparkSession, d: str) -> DataFrame:
    """One scalar subquery per rule."""
    part = spark.read.parquet(f"{d}/part.parquet")
    chosen = F
    for rule in _NAME_RULES:
        parent = part.where(F.col("p_name") == rule.parent["p_name"]).agg(F.min("p_partkey")).scalar()
        chosen = chosen.when(rule.condition(), parent)
    return part.select("p_partkey", "p_name", chosen.alias("parent_id"))


def plain_slot_pivot(spark: SparkSession, d: str) -> DataFrame:
    """All rows of an order numbered, one column per slot, then the lowest of each."""
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_suppkey", "l_partkey").distinct()
    w = W.partitionBy("l_orderkey").orderBy("l_suppkey", "l_partkey")
    rows, cols = lines.withColumn("row", F.row_number().over(w)), []
    for i in (1, 2, 3):
        for c in ("l_suppkey", "l_partkey"):
            rows = rows.withColumn(f"{c}{i}", F.when(F.col("row") == i, F.col(c)).otherwise(F.lit(None)))
            cols.append(f"{c}{i}")
    return rows.groupBy("l_orderkey").agg(*[F.min(c).alias(c) for c in cols])


def plain_latest_one(spark: SparkSession, d: str) -> DataFrame:
    events = spark.read.parquet(f"{d}/events.parquet").withColumn("day", F.to_date("ts"))
    w = W.partitionBy("user_id", "event_type").orderBy(F.desc("day"), F.desc("event_id"))
    rows = events.withColumn("rank", F.rank().over(w)).where("rank = 1")
    return rows.select("event_id", "user_id", "event_type", "ts", "value")


def plain_latest_all_ties(spark: SparkSession, d: str) -> DataFrame:
    events = spark.read.parquet(f"{d}/events.parquet").withColumn("day", F.to_date("ts"))
    w = W.partitionBy("user_id", "event_type").orderBy(F.desc("day"))
    return events.withColumn("rank", F.rank().over(w)).where("rank = 1").select("event_id", "user_id", "event_type", "day")


def plain_fallback_chain(spark: SparkSession, d: str) -> DataFrame:
    """Join, fan out, keep one row per customer; once per step."""
    read = spark.read.parquet
    nations = read(f"{d}/nation.parquet")
    suppliers = read(f"{d}/supplier.parquet").join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    suppliers = suppliers.withColumn("band", F.floor(F.col("s_acctbal") / 1000))
    near = nations.select(F.col("n_nationkey").alias("nk"), F.col("n_regionkey").alias("rk"))
    rows = read(f"{d}/customer.parquet").join(near, F.col("c_nationkey") == F.col("nk"), "left")
    rows = rows.withColumn("b", F.floor(F.col("c_acctbal") / 1000)).withColumn("found", F.lit(None).cast("long"))
    steps = [
        (suppliers, (F.col("c_nationkey") == F.col("s_nationkey")) & (F.col("b") == F.col("band"))),
        (suppliers.where("s_acctbal > 5000"), F.col("c_nationkey") == F.col("s_nationkey")),
        (suppliers, F.col("rk") == F.col("n_regionkey")),
    ]
    kept = ["c_custkey", "c_nationkey", "rk", "b", "found"]
    one = W.partitionBy("c_custkey").orderBy("s_suppkey")
    for dim, condition in steps:
        rows = rows.select(*kept).join(dim, condition, "left")
        rows = rows.withColumn("found", F.coalesce("found", "s_suppkey"))
        rows = rows.withColumn("row", F.row_number().over(one)).where("row = 1")
    return rows.select("c_custkey", F.col("found").alias("supplier_id"))


def plain_bridge(spark: SparkSession, d: str) -> DataFrame:
    """Distinct pairs numbered by one window over all of them."""
    lines, orders = spark.read.parquet(f"{d}/lineitem.parquet"), spark.read.parquet(f"{d}/orders.parquet")
    pairs = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_partkey").distinct()
    return pairs.withColumn("pair_id", F.row_number().over(W.orderBy("o_custkey", "l_partkey")) - 1)


def plain_collapse_slots(spark: SparkSession, d: str) -> DataFrame:
    """All rows of an order numbered, then every column reduced on its own."""
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    rows = lines.withColumn("i", F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_suppkey", "l_linenumber", "l_partkey")))
    slots = [F.min(F.when(F.col("i") == i, F.col("l_suppkey"))).alias(f"l_suppkey{i}") for i in (1, 2)]
    return rows.groupBy("l_orderkey").agg(F.min("l_returnflag").alias("l_returnflag"), F.max("l_shipdate").alias("l_shipdate"), *slots)


def plain_lookup_salted(spark: SparkSession, d: str) -> DataFrame:
    """The join as Spark plans it."""
    lines, suppliers = spark.read.parquet(f"{d}/lineitem.parquet"), spark.read.parquet(f"{d}/supplier.parquet")
    joined = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.min("s_name").alias("s_name"), F.max("s_nationkey").alias("s_nationkey"))


PLAIN = {
    "bridge": plain_bridge,
    "collapse_slots": plain_collapse_slots,
    "lookup_salted": plain_lookup_salted,
    "dense_id": plain_dense_id,
    "rule_parent_simple": plain_rule_parent_simple,
    "slot_pivot": plain_slot_pivot,
    "latest_one": plain_latest_one,
    "latest_all_ties": plain_latest_all_ties,
    "fallback_chain": plain_fallback_chain,
}


def seconds(build, spark: SparkSession, folder: str, repeat: int) -> float:
    times = []
    for i in range(repeat + 1):
        start = time.perf_counter()
        build(spark, folder).write.format("noop").mode("overwrite").save()
        if i:
            times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    built = {name: seconds(QUERIES[name], spark, folder, repeat) for name in HEADLINE}
    plain = {name: seconds(build, spark, folder, repeat) for name, build in PLAIN.items()}
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians", "value": round(sum(built.values()), 3), "unit": "sec",
                "queries": built, "plain": plain, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
