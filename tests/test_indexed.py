"""Rules by their literals, and all checks of a set of tables at once, against the plain forms."""

import random

import pytest

from snowloom.operators import enrich, quality
from snowloom.operators.enrich import ParentRule, RuleIndex
from snowloom.operators.quality import Check


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def made_rules(rng, n):
    """Rules of all forms over short texts, so that many fit and overlap."""
    def pattern():
        text = "".join(rng.choice("ab ") for _ in range(rng.randint(0, 3)))
        form = rng.choice(["{}", "{}%", "%{}", "%{}%", "a%{}", "_{}%", "{}%_", "%"])
        return form.format(text) or "%"

    out = []
    for _ in range(n):
        when = {c: [pattern() for _ in range(rng.randint(1, 2))] for c in rng.sample(["x", "y"], rng.randint(0, 2))}
        unless = {c: [pattern()] for c in rng.sample(["x", "y"], rng.randint(0, 1))}
        if when or unless:
            out.append(ParentRule(when, {"x": rng.choice(["a", "ab", "b b", "nobody"])}, unless))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_indexed_rules_equal_the_case_form(spark, seed):
    rng = random.Random(seed)
    texts = [None, "", "a", "ab", " a ", "b b", "aab", "ba", "aé", "é", "abab ab"]
    data = [(i, rng.choice(texts), rng.choice(texts)) for i in range(300)] + [(300, "a", None), (301, "nobody2", "x")]
    df = spark.createDataFrame(data, "id int, x string, y string")
    rules = made_rules(rng, 40)
    want = rows(enrich.resolve_parent(df, rules, df, "id", "parent"))
    assert rows(enrich.resolve_parent_indexed(df, rules, df, "id", "parent")) == want
    assert len({r[-1] for r in want}) > 1
    assert rows(enrich.resolve_parent_indexed(df, [], df, "id", "parent")) == rows(enrich.resolve_parent(df, [], df, "id", "parent"))


def test_probes_do_not_grow_with_the_rules(spark):
    rules = [ParentRule({"x": [f"name {i:05d}%"]}, {"x": "p"}) for i in range(2000)] + [ParentRule({"x": [f"%{i:04d}"]}, {"x": "p"}) for i in range(2000)]
    index = RuleIndex(rules)
    assert len(index.entries) == 4000 and len(index.lengths) == 2 and not index.outside
    index = RuleIndex([ParentRule({"x": ["%a%"]}, {"x": "p"}), ParentRule({}, {"x": "p"}, {"x": ["a"]}), ParentRule({"x": ["%a%", "b"], "y": ["long%", "longer"]}, {"x": "p"})])
    assert index.outside == [0, 1] and {e[:3] for e in index.entries} == {(1, "start", "long"), (1, "whole", "longer")}


def tables(spark):
    child = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, None, 9), (None, "b", None), (None, "b", 1), (3, 'q"[', 7)], "k int, t string, f long")
    first = spark.createDataFrame([(1, "a"), (2, None)], "p long, q string")
    other = spark.createDataFrame([("7",), (None,)], "o string")
    return {"child": child, "first": first, "other": other, "unused": first}


def test_audits_at_once_equal_separate_ones(spark):
    t = tables(spark)
    checks = [
        Check("child", "unique", ["k", "t"]), Check("child", "unique", ["t"]), Check("child", "required", ["k", "t", "f"]),
        Check("child", "reference", ["f"], [("first", ["p"]), ("other", ["o"])]), Check("child", "reference", ["k", "t"], [("first", ["p", "q"])]),
        Check("first", "required", ["p"]), Check("other", "required", ["o"]), Check("first", "reference", ["p"], [("child", ["k"])]),
    ]
    got = quality.audit_tables(t, checks)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 3
    found = {}
    for r in got.collect():
        found.setdefault(r["check"], set()).add((r.key, r.n))
        assert (r.table_name, r.kind) == (checks[r["check"]].table, checks[r["check"]].kind)
    assert {i: len(quality.audit_unique(t["child"], checks[i].columns).collect()) for i in (0, 1)} == {i: len(found[i]) for i in (0, 1)}
    assert found[0] == {('["1","a"]', 2), ('[null,"b"]', 2)}
    assert found[2] == {(r.column_name, r.nulls) for r in quality.audit_not_null(t["child"], ["k", "t", "f"]).collect() if r.nulls}
    assert found[3] == {('["9"]', 1)} and found[4] == {('["3","q\\"["]', 1)}
    assert 5 not in found and found[6] == {("o", 1)} and 7 not in found
    with pytest.raises(ValueError):
        quality.audit_tables({"child": t["child"]}, checks)
    for wrong in (("child", "other", ["k"]), ("child", "reference", ["k"])):
        with pytest.raises(ValueError):
            Check(*wrong)
