"""Batches that come again, current tables kept by merges, keys noted at landing, streams as landings."""

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from snowloom import sinks
from snowloom.operators import versioning
from snowloom.plans import warehouse
from snowloom.sinks import Layout
from snowloom.streaming import land_stream, landing_number

DAYS = [datetime.date(2024, 1, 1) + datetime.timedelta(days=i) for i in range(8)]


@pytest.fixture(scope="module")
def database(spark):
    sinks.ensure_database(spark, "keep_test", reset=True)
    return "keep_test"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def read_partitions(df):
    """The partition conditions of the scans of a plan, and the number of files they leave."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"PartitionFilters: \[(.*?)\]", plan), len(df.inputFiles())


def test_replaced_slice_leaves_nothing_behind(spark, database):
    table, layout = f"{database}.places", Layout(("kind", "upd_date"))

    def store(day, found):
        df = spark.createDataFrame(found, "id int, kind string").withColumn("upd_date", F.lit(day))
        sinks.replace_slice(df, table, layout, {"upd_date": day})

    store(DAYS[0], [(1, "a"), (2, "b/c=d 'x"), (3, None)])
    store(DAYS[1], [(1, "a"), (9, "z")])
    assert len(sinks.filled(spark, table, {"upd_date": DAYS[0]})) == 3
    store(DAYS[0], [(1, "e"), (3, "a")])
    want = [(1, "a", DAYS[1]), (9, "z", DAYS[1]), (1, "e", DAYS[0]), (3, "a", DAYS[0])]
    assert rows(spark.table(table)) == sorted(want, key=repr)
    store(DAYS[1], [])
    assert rows(spark.table(table)) == sorted(want[2:], key=repr)
    alone = f"{database}.alone"
    for found in ([(1,)], [(2,)], []):
        sinks.replace_slice(spark.createDataFrame(found, "id int").withColumn("upd_date", F.lit(DAYS[0])), alone, Layout(("upd_date",)), {"upd_date": DAYS[0]})
        assert rows(spark.table(alone)) == [(*r, DAYS[0]) for r in found]


@pytest.mark.parametrize("ties, seed", [("one", 1), ("all", 2)])
def test_merges_equal_the_newest_of_all_batches(spark, database, ties, seed):
    """Batches in any order, some late, some again with other rows; null keys and null values among them."""
    rng, table, history = random.Random(seed), f"{database}.current{seed}", {}
    schema = "k int, l string, v int, upd_date date"
    for step in range(7):
        day = rng.choice(DAYS[:4])
        found = [(rng.choice([None, *range(12)]), rng.choice(["x", None]), rng.randrange(100)) for _ in range(rng.randint(0, 14))]
        if ties == "one":
            found = [(k, l, v) for (k, l), v in {(k, l): v for k, l, v in found}.items()]
        if not found and day in history:
            # An empty repeat bears no date in its rows, so nothing says whose place it takes.
            continue
        history[day] = [(*r, day) for r in found]
        whole = spark.createDataFrame([r for held in history.values() for r in held], schema)
        sinks.merge(spark.createDataFrame(history[day], schema), table, ["k", "l"], "upd_date", ties, ["v"], Layout((), 4, ("k",)), whole)
        assert rows(spark.table(table)) == rows(versioning.latest(whole, ["k", "l"], "upd_date", ties, ["v"])), step
    assert sinks.tidy(spark, table) >= 0 and sinks.tidy(spark, table) == 0


def test_merge_reads_and_writes_touched_partitions_alone(spark, database):
    table, schema = f"{database}.touched", "k int, v int, upd_date date"
    for i, day in enumerate(DAYS):
        sinks.merge(spark.createDataFrame([(10 * i + j, i, day) for j in range(10)], schema), table, ["k"], "upd_date")
    before = sinks.live(spark, table)
    old = spark.table(table)
    later = DAYS[-1] + datetime.timedelta(days=1)
    # Two keys of the third batch, one new key.
    written = sinks.merge(spark.createDataFrame([(20, 99, later), (21, 99, later), (500, 99, later)], schema), table, ["k"], "upd_date")
    assert written == [str(DAYS[2]), str(later)]
    after = sinks.live(spark, table)
    assert {d for d in before if before[d] == after.get(d)} == {str(d) for d in DAYS} - {str(DAYS[2])}
    # A reader that began before the merge still sees what it saw.
    assert old.count() == 80 and spark.table(table).count() == 81
    filters, files = read_partitions(spark.table(table).where(F.col("upd_date") == DAYS[2]))
    assert "upd_date" in filters[0] and files == 1
    # All keys of a partition moved: it is gone.
    sinks.merge(spark.createDataFrame([(70 + j, 1, later + datetime.timedelta(days=1)) for j in range(10)], schema), table, ["k"], "upd_date")
    assert str(DAYS[7]) not in sinks.live(spark, table) and spark.table(table).count() == 81


def test_published_table_is_taken_over(spark, database):
    table, schema = f"{database}.published", "k int, v int, upd_date date"
    sinks.publish(spark.createDataFrame([(1, 1, DAYS[0]), (2, 1, DAYS[0])], schema), table)
    sinks.merge(spark.createDataFrame([(2, 2, DAYS[1])], schema), table, ["k"], "upd_date")
    assert rows(spark.table(table)) == [(1, 1, DAYS[0]), (2, 2, DAYS[1])]


def test_batches_without_a_key_are_not_read(spark, database):
    table = f"{database}.indexed"
    for i, day in enumerate(DAYS):
        df = spark.createDataFrame([(100 * i + j, j) for j in range(50)] + ([(7, -1)] if i in (3, 5) else []), "k int, v int")
        sinks.land(df, table, day, index=["k"])
    within = spark.createDataFrame([(d,) for d in DAYS], "upd_date date")
    wanted = spark.createDataFrame([(7,), (7,), (99999,)], "k int")
    found = sinks.holding(spark, table, wanted, ["k"], within)
    assert rows(found) == [(DAYS[i],) for i in (0, 3, 5)]
    read = sinks.batches(spark, table, found)
    filters, _ = read_partitions(read)
    assert all(str(DAYS[i]) in filters[0] for i in (0, 3, 5)) and str(DAYS[1]) not in filters[0]
    assert rows(versioning.only_keys(read, wanted, ["k"])) == rows(spark.table(table).where("k = 7"))
    # Landed again without the key.
    sinks.land(spark.createDataFrame([(8, 8)], "k int, v int"), table, DAYS[3], index=["k"])
    assert rows(sinks.holding(spark, table, wanted, ["k"], within)) == [(DAYS[0],), (DAYS[5],)]
    # Another key was not noted, and a batch landed without an index is read to be safe.
    assert rows(sinks.holding(spark, table, wanted.withColumnRenamed("k", "v"), ["v"], within)) == rows(within)
    sinks.land(spark.createDataFrame([(8, 8)], "k int, v int"), table, datetime.date(2025, 1, 1))
    more = within.union(spark.createDataFrame([(datetime.date(2025, 1, 1),)], "upd_date date"))
    assert rows(sinks.holding(spark, table, wanted, ["k"], more)) == [(DAYS[0],), (DAYS[5],), (datetime.date(2025, 1, 1),)]


def test_landings_need_no_clock(spark, database, monkeypatch):
    """Two machines land one date, the second with a clock far behind: its landing is pending all the same."""
    import time

    table, marks = f"{database}.clocks", f"{database}.clock_marks"
    assert sinks.pin(spark, table, marks).isEmpty()
    sinks.land(spark.range(3), table, DAYS[0])
    sinks.mark_consumed(sinks.pin(spark, table, marks), table, marks)
    assert sinks.pin(spark, table, marks).isEmpty()
    monkeypatch.setattr(time, "time_ns", lambda: 1)
    sinks.land(spark.range(2), table, DAYS[0])
    assert sinks.pending(spark, table, marks).count() == 2


def test_repeated_micro_batch_counts_once(spark, database, tmp_path):
    table, marks, files, state = f"{database}.streamed", f"{database}.stream_marks", f"{tmp_path}/in", f"{tmp_path}/state"
    spark.range(5).write.parquet(files)
    land_stream(spark, files, spark.range(1).schema, table, state, DAYS[0], index=["id"])
    sinks.mark_consumed(sinks.pin(spark, table, marks), table, marks)
    # The first micro-batch again, a day later, as after a failure before its commit was noted.
    sinks.land(spark.range(5), table, DAYS[1], Layout(("upd_date", "landing")), landing_number(state, 0), index=["id"])
    spark.range(5, 9).write.mode("append").parquet(files)
    land_stream(spark, files, spark.range(1).schema, table, state, DAYS[1], index=["id"])
    land_stream(spark, files, spark.range(1).schema, table, state, DAYS[1], index=["id"])
    spark.catalog.refreshTable(table)
    assert sorted(r.id for r in spark.table(table).collect()) == list(range(9))
    assert landing_number(state, 0) != landing_number(state, 1) != landing_number(f"{state}x", 1)
    pinned = sinks.pin(spark, table, marks)
    assert sorted(r.id for r in sinks.batches(spark, table, pinned).collect()) == list(range(5, 9))


def test_run_before_all_sources_have_landed(spark):
    """Nothing has landed yet in two of three sources: a run does what there is to do, here nothing."""
    sinks.ensure_database(spark, "stg_empty", reset=True)
    w = warehouse.run(spark, "stg_empty", "dwh_empty", DAYS[0])
    assert all(p.isEmpty() for p in w.pinned.values()) and w.tables.number == 0 and not w.tables.base


def store(spark, database, day, n):
    """One run: two tables that tell the same number."""
    c = sinks.Commit(spark, database)
    c.put("facts", spark.range(n).select("id", F.lit(day).alias("upd_date")), "upd_date", day)
    c.publish("total", c.frame("facts").agg(F.count("*").alias("n")))
    return c


def told(spark, database):
    return spark.table(f"{database}.facts").count(), spark.table(f"{database}.total").first()[0]


@pytest.fixture
def committed(spark):
    database = "commit_test"
    sinks.ensure_database(spark, database, reset=True)
    assert store(spark, database, DAYS[0], 3).commit() == 1
    return database


def test_run_that_dies_leaves_nothing(spark, committed):
    c = store(spark, committed, DAYS[1], 5)
    assert c.frame("facts").count() == 8 and told(spark, committed) == (3, 3)
    assert sinks.at(spark, committed).frame("facts").count() == 3
    # It never commits; the next run does not see its rows and commits as if it had not been.
    again = store(spark, committed, DAYS[1], 2)
    assert again.commit() == 2 and told(spark, committed) == (5, 5)
    assert len(sinks.versions(spark, f"{committed}.total")) == 3
    again.sweep()
    assert len(sinks.versions(spark, f"{committed}.total")) == 2 and told(spark, committed) == (5, 5)
    assert spark.table(f"{committed}.facts__rows").count() == 5


def test_of_two_runs_one_commits(spark, committed):
    one, other = store(spark, committed, DAYS[1], 5), store(spark, committed, DAYS[1], 7)
    assert other.commit() == 2
    with pytest.raises(sinks.Conflict):
        one.commit()
    assert told(spark, committed) == (10, 10)
    # The file decides, whatever was looked at before it.
    late = store(spark, committed, DAYS[2], 1)
    late.number -= 1
    with pytest.raises(sinks.Conflict):
        late.commit()
    assert told(spark, committed) == (10, 10)


def test_views_behind_a_commit_are_put_right(spark, committed, monkeypatch):
    c = store(spark, committed, DAYS[1], 4)
    monkeypatch.setattr(sinks.Commit, "show", lambda self, names=None: None)
    assert c.commit() == 2 and told(spark, committed) == (3, 3)
    monkeypatch.undo()
    # Who reads by commit sees it at once; the views follow with the next look.
    assert sinks.at(spark, committed).frame("facts").count() == 7
    sinks.at(spark, committed).show()
    assert told(spark, committed) == (7, 7)
    assert sinks.at(spark, committed, 1).frame("facts").count() == 3


def test_unfinished_commit_stops_the_next_run(spark, committed):
    from snowloom.sinks import commits

    folder, fs = commits._folder(spark, committed)
    fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, "0000000002.json"), False).close()
    with pytest.raises(sinks.Conflict):
        sinks.Commit(spark, committed)
    assert sinks.at(spark, committed).number == 1
    with pytest.raises(ValueError):
        commits.abandon(spark, committed, 1)
    commits.abandon(spark, committed, 2)
    assert store(spark, committed, DAYS[1], 1).commit() == 2


def test_old_states_are_tidied(spark, committed):
    for i, day in enumerate(DAYS[1:5], 1):
        c = store(spark, committed, day, i)
        c.put("facts", c.frame("facts").where("id = 0").where(F.col("upd_date") == DAYS[0]), "upd_date", DAYS[0])
        c.commit()
        c.tidy()
    assert len(sinks.versions(spark, f"{committed}.total")) == 2
    assert len(sinks.filled(spark, f"{committed}.facts__rows", {"upd_date": DAYS[0]})) == 2
    assert sinks.at(spark, committed).frame("facts").count() == spark.table(f"{committed}.facts").count() == 11
    assert sinks.Commit(spark, committed).commit() == 5
