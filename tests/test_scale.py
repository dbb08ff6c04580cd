"""Plans and partition sizes that must hold when one key has a third of the rows."""

import contextlib
import glob
import os
import threading

import pytest
from compare import plan
from conftest import DATA
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from snowloom import sinks
from snowloom.operators import enrich, keys, reshape, skew, versioning
from snowloom.queries.registry import QUERIES, Tables
from snowloom.queries.world import frame
from snowloom.session import RUNTIME_CONF, materialize, scratch_folder, scratch_scope, setting, tune
from snowloom.sinks.tables import Layout, gathered

ROWS = 30_000


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows have key 0."""
    tune(spark)
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1)
    return materialize(spark.range(ROWS).select(key.alias("k"), F.col("id").alias("v"), (F.col("id") % 5).alias("d")), "hot")


def largest_partition(df) -> int:
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_settings_exist(spark):
    tune(spark)
    for key, value in RUNTIME_CONF.items():
        assert spark.conf.get(key) == value


def test_heavy_keys_are_few_and_found(hot):
    assert [r["k"] for r in skew.heavy_keys(hot, ["k"], share=0.1).collect()] == [0]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_is_the_plain_join(spark, hot, how):
    dim = spark.range(0, 500).select(F.col("id").alias("key"), (F.col("id") * 2).alias("w"))
    plain = hot.join(dim, F.col("k") == F.col("key"), how)
    salted = skew.salted_join(hot, dim, [("k", "key")], how, share=0.1)
    assert sorted(salted.columns) == sorted(plain.columns)
    assert salted.exceptAll(plain.select(*salted.columns)).isEmpty() and salted.count() == plain.count()


def test_salted_join_spreads_the_heavy_key(spark, hot):
    dim = spark.range(0, 1000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("w"))
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), setting(spark, "spark.sql.adaptive.enabled", "false"):
        plain = hot.join(dim, F.col("k") == F.col("key"))
        assert largest_partition(plain) > ROWS / 3
        assert largest_partition(skew.salted_join(hot, dim, [("k", "key")], "inner", share=0.1)) < ROWS / 5


def test_adaptive_split_of_a_lookup_under_an_aggregate(spark, hot):
    dim = spark.range(0, 1000).select(F.col("id").alias("key"), F.concat(F.lit("name "), "id").alias("name"))
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    with contextlib.ExitStack() as stack:
        for name, value in names.items():
            stack.enter_context(setting(spark, name, value))
        counted = enrich.lookup(hot.repartition(8), dim, {"k": "key"}, ["name"]).groupBy("k").agg(
            F.count("name").alias("n"), F.max("v")
        )
        counted.collect()
        assert "skew=true" in plan(counted)


def test_first_rows_and_latest_shrink_before_the_shuffle(hot):
    for df in (
        reshape.first_rows(hot, ["k"], ["v"], 3, "n"),
        reshape.slots(hot, ["k"], ["v"], ["d"], 3),
        versioning.latest(hot, ["k"], "v"),
        versioning.upsert_latest(hot, hot, ["k"], "v"),
    ):
        text = plan(df)
        limit, exchange = text.index("Partial"), text.index("Exchange hashpartitioning")
        assert "WindowGroupLimit" in text and limit > exchange  # lower in the tree, so printed later


def test_latest_with_ties_has_no_window(hot):
    assert "Window" not in plan(versioning.latest(hot, ["k"], "d", ties="all"))


def test_collapse_with_slots_joins_without_another_shuffle(spark, hot):
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        text = plan(reshape.collapse_with_slots(hot, ["k"], ["v"], ["v"], 3, ["d"], ["v"]))
    assert text.count("Exchange") == 2


def test_dense_id_cuts_one_order_value_into_ranges(spark, hot):
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        numbered = keys.dense_id(hot, ["k"], "n", partitions=16)
    folder = next(f for f in numbered.inputFiles() if "dense-id" in f).rsplit("/", 1)[0]
    sizes = [r["count"] for r in spark.read.parquet(folder).groupBy("__part").count().collect()]
    assert sum(sizes) == ROWS and max(sizes) < ROWS / 6
    assert "SinglePartition" in plan(numbered)  # the range sizes alone
    assert numbered.agg(F.count_distinct("n"), F.min("n"), F.max("n")).first() == (ROWS, 0, ROWS - 1)


@pytest.fixture(scope="module")
def copies(spark):
    """A third of the rows are exact copies of one, the others of fifty."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50 + 100)
    return spark.range(ROWS).select(key.alias("k"))


def test_dense_id_of_exact_copies(spark, copies):
    numbered = keys.dense_id(copies, ["k"], "n", partitions=16)
    assert numbered.agg(F.count_distinct("n"), F.min("n"), F.max("n")).first() == (ROWS, 0, ROWS - 1)
    ends = numbered.groupBy("k").agg(F.min("n").alias("a"), F.max("n").alias("b"), F.count("n").alias("c")).orderBy("k").collect()
    assert all(r.b - r.a + 1 == r.c for r in ends) and all(x.b + 1 == y.a for x, y in zip(ends, ends[1:]))
    folder = next(f for f in numbered.inputFiles() if "dense-id" in f).rsplit("/", 1)[0]
    # Copies go through the ranges once.
    assert spark.read.parquet(folder).count() == 51


def test_salted_join_of_exact_copies(spark, copies):
    dim = spark.range(200).select(F.col("id").alias("d"), (F.col("id") * 2).alias("v"))
    got = skew.salted_join(copies, dim, [("k", "d")], "left", salts=16)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, copies.join(dim, F.col("k") == F.col("d"), "left").collect()))
    merged = skew.collapsed(copies)
    assert merged.count() == 51 and merged.agg(F.sum("__copies")).first()[0] == ROWS
    assert skew.collapsed(spark.range(5000)) is None


def test_first_match_resolves_each_reference_once(spark, hot):
    dim = spark.range(0, 1000).select(F.col("id").alias("key"), F.col("id").alias("found"))
    got = enrich.first_match(hot, [enrich.Candidate(dim, {"k": "key"}, "found")], "f")
    assert "BroadcastHashJoin" in plan(got) and "Exchange hashpartitioning" not in plan(got)
    assert got.where("f = k").count() == ROWS


def test_partitions_of_a_write_are_split_when_large(spark, hot):
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB"):
        written = materialize(gathered(hot.repartition(8), Layout(("k",))).withColumn("task", F.spark_partition_id()), "split")
    assert written.where("k = 0").select("task").distinct().count() > 1
    assert written.count() == ROWS


def test_scratch_follows_the_session_and_is_removed(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    with scratch_scope(spark):
        df = materialize(spark.range(3), "kept")
        folder = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert folder.startswith(base) and os.path.isdir(folder)
    assert not os.path.exists(folder)

    class Session:
        def __init__(self, **settings):
            self.conf = settings

    with pytest.raises(ValueError):
        scratch_folder(Session(**{"spark.master": "yarn"}), "x")
    own = [scratch_folder(Session(**{"spark.master": "local[8]"}), "x") for _ in range(2)]
    assert own[0] != own[1] and os.path.dirname(own[0]) == os.path.dirname(own[1])
    shared = Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://shared/dir/"})
    assert scratch_folder(shared, "x").startswith("hdfs://shared/dir/x-")


def test_scopes_inside_and_beside_each_other(spark):
    def folder(df):
        return df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]

    with scratch_scope(spark):
        outer = folder(materialize(spark.range(3), "outer"))
        with scratch_scope(spark):
            inner = folder(materialize(spark.range(3), "inner"))
        assert os.path.isdir(outer) and not os.path.exists(inner)
    assert not os.path.exists(outer)

    opened, ended, seen = threading.Event(), threading.Event(), []

    def beside():
        with scratch_scope(spark):
            df = materialize(spark.range(5), "beside")
            opened.set()
            ended.wait(60)
            seen.append(df.count())

    thread = threading.Thread(target=beside)
    with scratch_scope(spark):
        thread.start()
        opened.wait(60)
    ended.set()
    thread.join(60)
    assert seen == [5]


def test_bucketed_tables_join_where_they_are(spark):
    sinks.ensure_database(spark, "bucket_test", reset=True)
    orders = spark.read.parquet(f"{DATA}/sf0.001/orders.parquet")
    lines = spark.read.parquet(f"{DATA}/sf0.001/lineitem.parquet")
    layout = Layout((), 8, ("o_orderkey",))
    sinks.create_table(orders.select("o_orderkey", "o_custkey"), "bucket_test.orders", layout)
    sinks.insert(orders.select("o_orderkey", "o_custkey"), "bucket_test.orders", layout)
    sinks.create_table(lines.select("l_orderkey", "l_partkey"), "bucket_test.lines", Layout((), 8, ("l_orderkey",)))
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        joined = spark.table("bucket_test.lines").join(spark.table("bucket_test.orders"), F.expr("l_orderkey = o_orderkey"))
        text = plan(joined)
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert joined.count() == 2 * lines.count()


def test_landing_one_date_moves_no_rows(spark, hot):
    text = plan(gathered(hot.withColumn("upd_date", F.lit("2024-01-01")), Layout(("upd_date",)), ["upd_date"]))
    assert "Exchange" not in text


def test_scans_read_only_what_is_used(spark):
    text = plan(entry_points.queries()["inner_chain"](spark, f"{DATA}/sf0.001"))
    assert "EqualTo(o_orderstatus,F)" in text
    line = next(x for x in text.splitlines() if "lineitem.parquet" in x or "l_orderkey" in x and "FileScan" in x)
    assert "l_shipdate" not in line


def test_dense_id_computes_its_input_once(spark):
    tune(spark)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    numbered = keys.dense_id(spark.range(1000).mapInArrow(counted, "id long"), ["id"], "n", partitions=4)
    assert numbered.where("n = id").count() == 1000
    assert seen.value == 1000


def test_laureate_files_are_made_without_a_shuffle_of_wide_rows(spark, tmp_path):
    """Two suppliers of one order give one row where the laureate works nowhere, and copies of a line give one."""
    tune(spark)
    n = 5000
    tables = {
        "region": "0 AS r_regionkey, 'r' AS r_name", "nation": "0 AS n_nationkey, 0 AS n_regionkey, 'n' AS n_name",
        "customer": "id AS c_custkey, concat('c', id) AS c_name, 1 AS c_nationkey, 0D AS c_acctbal, 'HOUSEHOLD' AS c_mktsegment",
        "supplier": "id AS s_suppkey, concat('s', id) AS s_name, 1 AS s_nationkey, 0D AS s_acctbal",
        "part": "id AS p_partkey", "events": "id AS event_id",
        "orders": "id AS o_orderkey, id % 100 AS o_custkey, if(id % 2 = 0, 'F', NULL) AS o_orderstatus, "
        "TIMESTAMP_NTZ'1995-01-01 00:00:00' AS o_orderdate, '1-URGENT' AS o_orderpriority",
        "lineitem": f"id % {n} AS l_orderkey, id DIV {2 * n} AS l_suppkey",
    }
    sizes = {"customer": n, "supplier": 2, "orders": n, "lineitem": 4 * n}
    for name, columns in tables.items():
        spark.range(sizes.get(name, 1)).selectExpr(*[columns] if "," not in columns else [f"struct({columns}) AS s"]).selectExpr(
            *["s.*"] if "," in columns else ["*"]
        ).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    t = Tables(spark, str(tmp_path))
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "10k"), setting(spark, "spark.sql.adaptive.enabled", "false"):
        joined, files = frame(t, "laureates"), frame(t, "laureates", "o_orderkey").drop("upd_date").distinct()
        assert plan(files).count("Exchange hashpartitioning") == plan(joined).count("Exchange hashpartitioning") > 0
    before = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/laureate-files-*/*"))
    got = QUERIES["load_staging_laureates"](spark, str(tmp_path))
    made = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/laureate-files-*/*.csv*")) - before
    assert made and all(f.endswith(".csv.gz") for f in made)
    nowhere = sum(1 for i in range(n) if i % 100 % 7 == 3)
    assert got.count() == got.distinct().count() == 2 * (n - nowhere) + nowhere
