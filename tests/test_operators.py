"""One hand-written case per point of meaning."""

import datetime

import pytest
from pyspark.sql import functions as F

from snowloom import sinks, sources
from snowloom.functions import in_list, typed
from snowloom.operators import conform, enrich, keys, quality, reshape, versioning
from snowloom.operators.enrich import Candidate, ParentRule, Step
from snowloom.sinks import Layout


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def test_remap_trims_only_to_compare(spark):
    df = spark.createDataFrame([("a ",), (" b",), ("a",), (None,)], "c string")
    assert rows(conform.remap(df, "c", {"a": "A"})) == [(" b",), ("A",), ("A",), (None,)]
    assert rows(conform.remap(df, "c", {"a": "A"}, trim=False)) == [(" b",), ("A",), ("a ",), (None,)]


def test_decode_gives_default_for_unknown_and_null(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    assert rows(conform.decode(df, "c", "l", {"a": "A"})) == [("a", "A"), ("z", ""), (None, "")]


def test_cast_turns_bad_text_into_null(spark):
    df = spark.createDataFrame([("12", "1.239", "2020-02-30"), ("x", "12345.6", "2020-02-29")], "i string, d string, t string")
    typed = rows(conform.cast_to(df, "i int, d decimal(4,2), t date").withColumn("d", F.col("d").cast("string")))
    assert typed == [(12, "1.24", None), (None, None, datetime.date(2020, 2, 29))]


def test_typed_refuses_only_what_the_cast_refuses(spark):
    texts = [
        "", " ", "1", " 1 ", "\t-7\n", "+5", "1.5", ".5", "-.5", "5.", "1e3", "1E-2", "--1", "+", ".", "e5", "abc", "12abc", "99999999999",
        "0x1F", "NaN", "\x7f3", "2020-01-01", "2020", "2020-1-2", " 2020-01-01 ", "2020-01-01T10:00", "2020-13-01", "epoch", "-2020-01-01",
        "+2020-01-01", "1,5", "١", "1-URGENT", "2020-01-01 x", "2020-01-01Z", "12020-01-01", "020-01-01", "2020-01-", "\n1\n2",
        "2020-01-01T\n", "1 2", "-", "1e", "1e+", "1.2.3", "12345678", "99999", "9" * 40, None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    for kind in ("int", "bigint", "smallint", "decimal(6,2)", "date", "double"):
        data_type = spark.createDataFrame([], f"c {kind}").schema["c"].dataType
        differing = df.where(~typed("c", data_type).eqNullSafe(F.col("c").try_cast(data_type)))
        assert differing.collect() == [], kind


def test_patch_first_arm_wins_and_later_columns_see_earlier_ones(spark):
    df = spark.createDataFrame([("x", None, None), ("y", "old", "keep")], "n string, a string, b string")
    rules = [
        ("a", [(F.col("n") == "x", "first"), (F.col("n") == "x", "second")]),
        ("b", [(F.col("a") == "first", "seen")]),
    ]
    assert rows(conform.patch(df, rules)) == [("x", "first", "seen"), ("y", "old", "keep")]


def test_override_keeps_an_empty_value_null(spark):
    df = spark.createDataFrame([("k ", ""), ("k", "v"), ("o", "v"), ("k", None)], "key string, c string")
    got = rows(conform.override(df, "key", "c", {"k": "K"}, empty_is_null=True))
    assert got == [("k ", None), ("k", "K"), ("k", "K"), ("o", "v")]


def test_threshold_split_boundary_and_null(spark):
    df = spark.createDataFrame([("ps", 34.8), ("ps", 34.9), ("ps", None), ("us", 1.0)], "c string, m double")
    got = rows(conform.threshold_split(df, "c", "ps", "m", 34.8, "low", "high"), "c")
    assert got == [("high",), ("low",), ("ps",), ("us",)]


def test_lookup_null_keys_never_match_and_duplicates_fan_out(spark):
    df = spark.createDataFrame([("a ",), (None,), ("z",)], "k string")
    dim = spark.createDataFrame([(" a", 2), ("a", 1), (None, 9)], "name string, id int")
    assert rows(enrich.lookup(df, dim, {"k": "name"}, ["id"])) == [("a ", 1), ("a ", 2), ("z", None), (None, None)]
    assert rows(enrich.lookup(df, dim, {"k": "name"}, ["id"], lowest=True)) == [("a ", 1), ("z", None), (None, None)]
    assert rows(enrich.lookup(df, dim, {"k": "name"}, ["id"], how="inner")) == [("a ", 1), ("a ", 2)]
    with pytest.raises(ValueError):
        enrich.lookup(df, dim, {"k": "name"}, {"id": "k"})


def test_lookup_chain_uses_earlier_columns(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    first = spark.createDataFrame([(1, 10)], "a int, b int")
    second = spark.createDataFrame([(10, "x")], "b int, c string")
    got = enrich.lookup_chain(df, [Step(first, "a", ["b"]), Step(second, "b", ["c"])])
    assert rows(got) == [(1, 10, "x"), (2, None, None)]


def test_first_match_takes_the_first_way_and_the_lowest_id(spark):
    df = spark.createDataFrame([("p", 1, 7), ("p", 2, 7), ("q", 3, None), (None, 1, 7), ("p", 1, 7)], "c string, k int, parent int")
    dim = spark.createDataFrame([("p", 1, 20), ("p", 1, 10), ("p", 7, 5)], "name string, k int, id int")
    listed = spark.createDataFrame([("q ", 99), ("p", 98)], "name string, id int")
    ways = [
        Candidate(dim, {"c": "name", "k": "k"}, "id"),
        Candidate(dim, {"c": "name", "parent": "k"}, "id"),
        Candidate(listed, {"c": "name"}, "id"),
    ]
    got = rows(enrich.first_match(df, ways, "found"))
    assert got == [("p", 1, 7, 10), ("p", 1, 7, 10), ("p", 2, 7, 5), ("q", 3, None, 99), (None, 1, 7, None)]


def test_outer_match_and_missing(spark):
    a = spark.createDataFrame([("x ", 1), ("y", 2), ("x ", 1), (None, 3)], "n string, i int")
    b = spark.createDataFrame([("x",), ("z",)], "m string")
    got = rows(enrich.outer_match(a, b, {"n": "m"}, ["i"], ["m"]))
    assert got == [(1, "x"), (2, None), (3, None), (None, "z")]
    assert rows(enrich.missing(a, b, {"n": "m"})) == [("y", 2), (None, 3)]


def test_parent_rules_order_negation_and_null(spark):
    df = spark.createDataFrame(
        [(0, "U, lab", "X"), (1, "U", "B"), (2, "U", "A"), (3, "U hall", None), (4, "other", "A"), (5, "U", "B")],
        "id int, name string, city string",
    )
    rules = [
        ParentRule({"name": ["U,%"]}, {"name": "U", "city": "B"}),
        ParentRule({"name": ["U%"]}, {"name": "other"}, unless={"city": ["B"]}),
        ParentRule({"name": ["%"]}, {"name": "nobody"}),
    ]
    got = dict(rows(enrich.resolve_parent(df, rules, df, "id", "parent"), "id", "parent"))
    assert got == {0: 1, 1: None, 2: 4, 3: None, 4: None, 5: None}


def test_with_parent_falls_back_to_the_row_itself(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 1, "b"), (3, 9, "c")], "id int, up int, name string")
    got = rows(enrich.with_parent(df, "id", "up", {"name": "parent"}), "id", "parent")
    assert got == [(1, "a"), (2, "a"), (3, "c")]


def test_in_list_compares_whole_names_trimmed(spark):
    df = spark.createDataFrame([("Scotland ",), ("Old (Poland)",), ("Old (Poland) ",)], "c string")
    assert rows(df.where(in_list(F.col("c"), ["%(Poland)", "Scotland"]))) == [("Old (Poland)",), ("Scotland ",)]


def test_dense_id_with_ties_nulls_and_a_start(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), F.when(F.col("id") > 5, F.col("id")).alias("v"))
    got = keys.dense_id(df, ["k"], "n", start=5, partitions=7).collect()
    assert sorted(r["n"] for r in got) == list(range(5, 1005))
    assert [r["k"] for r in sorted(got, key=lambda r: r["n"])] == sorted(r["k"] for r in got)
    assert keys.dense_id(df.where("k > 99"), ["k"], "n").count() == 0


def test_dense_id_numbers_identical_rows(spark):
    got = keys.dense_id(spark.range(300).select(F.lit("same").alias("k")), ["k"], "n", partitions=4)
    assert [r["n"] for r in got.orderBy("n").collect()] == list(range(300))


def test_stable_ids_null_is_a_key_and_ids_never_come_back(spark):
    known = spark.createDataFrame([(0, "a"), (7, None), (9, "gone")], "id long, k string")
    new = spark.createDataFrame([("b",), (None,), ("a",), ("c",)], "k string")
    assert rows(keys.stable_ids(new, known, ["k"], "id")) == [(0, "a"), (10, "b"), (11, "c"), (7, None)]


def test_next_id_of_nothing_is_zero(spark):
    empty = spark.createDataFrame([], "id long")
    assert spark.range(1).select(keys.next_id(empty, "id")).first()[0] == 0


def test_latest_ties_and_null_versions(spark):
    df = spark.createDataFrame(
        [("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", None, 4), ("b", None, 5), ("c", None, 6), ("c", 1, 7), (None, 3, 8), (None, 2, 9)],
        "k string, v int, i int",
    )
    assert rows(versioning.latest(df, ["k"], "v", ties="all"), "i") == [(2,), (3,), (4,), (5,), (7,), (8,)]
    assert rows(versioning.latest(df, ["k"], "v", tiebreak=["i"]), "i") == [(3,), (5,), (7,), (8,)]
    with pytest.raises(ValueError):
        versioning.latest(df, ["k"], "v", ties="some")


def test_upsert_with_an_empty_delta_changes_nothing(spark):
    prev = spark.createDataFrame([("a", 1)], "k string, v int")
    assert rows(versioning.upsert_latest(prev, prev.limit(0), ["k"], "v")) == [("a", 1)]
    assert rows(versioning.upsert_latest(None, prev, ["k"], "v")) == [("a", 1)]


def test_append_guarded_null_key_counts_as_known(spark):
    prev = spark.createDataFrame([(None, 1)], "k string, i int")
    new = spark.createDataFrame([(None, 2), ("x", 3), ("x", 4)], "k string, i int")
    assert rows(versioning.append_guarded(prev, new, ["k"])) == [("x", 3), ("x", 4)]


def test_slots_beyond_the_last_vanish_and_null_keys_have_slots(spark):
    df = spark.createDataFrame([("k", x) for x in "dbca"] + [(None, "z")], "k string, o string")
    got = rows(reshape.collapse_with_slots(df, ["k"], ["o"], ["o"], 3, [], ["o"]))
    assert got == [("k", "d", "a", "b", "c"), (None, "z", "z", None, None)]


def test_collapse_ignores_nulls(spark):
    df = spark.createDataFrame([(1, None, "b"), (1, 3, None), (2, None, None)], "k int, a int, b string")
    assert rows(reshape.collapse(df, ["k"], ["a"], ["b"])) == [(1, 3, "b"), (2, None, None)]


def test_normalise_keeps_null_values(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "x")], "i int, c string")
    fact, dims = reshape.normalise(df, {"c": ("c_id", ["c"])})
    assert rows(dims["c"]) == [(0, None), (1, "x")]
    assert rows(fact, "i", "c_id") == [(1, 1), (2, 0), (3, 1)]


def test_audits(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, None)], "k int, c string")
    assert rows(quality.audit_unique(df, ["k"])) == [(1, 2)]
    assert rows(quality.audit_not_null(df, ["k", "c"])) == [("c", 1), ("k", 1)]
    parent = spark.createDataFrame([(2,)], "id int")
    assert rows(quality.audit_fk(df, ["k"], [(parent, ["id"])])) == [(1, 2)]
    text = spark.createDataFrame([("12345",), ("x",), (None,)], "c string")
    assert rows(quality.audit_cast(text, "c int", {"c": 3})) == [("c", 1, 1)]


def test_csv_quotes_separators_and_bad_values(spark, tmp_path):
    (tmp_path / "f.csv").write_text('"H One","H Two"\n"a, \\"b\\"","7"\n"  c ","seven"\n', encoding="utf8")
    got = sources.read_csv(spark, str(tmp_path), "one string, two int", {"one": "first"})
    assert rows(got) == [("  c ", None), ('a, "b"', 7)]


def test_jdbc_options():
    plain = sources.jdbc_options("jdbc:x", "t", user="u")
    assert plain == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "10000", "user": "u"}
    split = sources.jdbc_options("jdbc:x", "t", "id", 0, 100, 4)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "0", "100", "4")
    with pytest.raises(ValueError):
        sources.jdbc_options("jdbc:x", "t", "id")


def test_sinks(spark):
    sinks.ensure_database(spark, "sink_test", reset=True)
    df = spark.createDataFrame([("x", 1, "p"), ("y", 2, "q")], "c string, i int, part string")
    layout = Layout(("part",), 4, ("i",))
    sinks.append(df, "sink_test.t", layout)
    sinks.append(df.select("part", "i", "c"), "sink_test.t", layout)
    assert rows(spark.table("sink_test.t")) == [("x", 1, "p"), ("x", 1, "p"), ("y", 2, "q"), ("y", 2, "q")]
    sinks.insert(df.where("part = 'p'"), "sink_test.t", layout, overwrite=True)
    assert rows(spark.table("sink_test.t")) == [("x", 1, "p"), ("y", 2, "q"), ("y", 2, "q")]
    sinks.insert(df.where("i > 9"), "sink_test.t", layout, overwrite=True)
    assert spark.table("sink_test.t").count() == 3
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    with pytest.raises(ValueError):
        sinks.land(df, "sink_test.u", "2024-01-01", layout)
    sinks.publish(df, "sink_test.v", Layout(("part",)))
    sinks.publish(spark.table("sink_test.v").where("i = 2"), "sink_test.v", Layout(("part",)))
    assert rows(spark.table("sink_test.v"), "i") == [(2,)]
    newest = sinks.publish(spark.table("sink_test.v"), "sink_test.v", Layout(("part",)))
    assert len(sinks.versions(spark, "sink_test.v")) == 3
    sinks.retire(spark, "sink_test.v", keep=1)
    assert sinks.versions(spark, "sink_test.v") == [newest]
    assert rows(spark.table("sink_test.v"), "i") == [(2,)]
    sinks.ensure_database(spark, "sink_test", reset=True)
    assert not spark.catalog.tableExists("sink_test.v")


def test_an_unfinished_publish_changes_nothing(spark):
    sinks.ensure_database(spark, "unfinished", reset=True)
    df = spark.createDataFrame([("x", 1), ("y", 2)], "c string, i int")
    first = sinks.publish(df.limit(1), "unfinished.v")
    second = sinks.publish(df, "unfinished.v")
    # A run that ended after its version was written, before the view was switched.
    sinks.create_table(df.where("i > 9"), "unfinished.v__v99999999999999999999_orphan")
    sinks.extend(spark.createDataFrame([("z", 3)], "c string, i int"), "unfinished.v")
    assert rows(spark.table("unfinished.v")) == [("x", 1), ("y", 2), ("z", 3)] and sinks.shown(spark, "unfinished.v") == second
    sinks.retire(spark, "unfinished.v", keep=2)
    assert sinks.versions(spark, "unfinished.v") == [first, second]
    sinks.retire(spark, "unfinished.v", keep=1)
    assert sinks.versions(spark, "unfinished.v") == [second] and spark.table("unfinished.v").count() == 3
    sinks.ensure_database(spark, "unfinished", reset=True)


def test_a_rule_without_conditions_is_refused():
    with pytest.raises(ValueError):
        enrich.ParentRule({}, {"name": "A"})
    with pytest.raises(ValueError):
        enrich.ParentRule({"name": ["A"]}, {})


def test_rules_name_parents_by_columns_of_their_own(spark):
    dim = spark.createDataFrame([(1, "A", "X"), (2, "B", "Y"), (3, "C", "Z")], "id long, name string, city string")
    rules = [enrich.ParentRule({"name": ["A"]}, {"name": "B"}), enrich.ParentRule({"name": ["B"]}, {"city": "Z"})]
    assert rows(enrich.resolve_parent(dim, rules, dim, "id", "parent"), "id", "parent") == [(1, 2), (2, 3), (3, None)]
    assert rows(enrich.resolve_parent(dim, [], dim, "id", "parent"), "parent") == [(None,)] * 3


def test_more_first_rows_than_the_limit_are_refused(spark):
    with pytest.raises(ValueError):
        reshape.first_rows(spark.range(3), ["id"], ["id"], 5000, "n")


def test_stamp_defaults_to_today(spark):
    today = spark.sql("select current_date()").first()[0]
    assert rows(sinks.stamp(spark.range(1)), "upd_date")[0][0] >= today
