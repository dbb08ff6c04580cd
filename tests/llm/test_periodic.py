"""Periodic runs against a direct search: random words over small alphabets, odd rows, the registered query."""

import os
import random
from fractions import Fraction

import pytest
from brute import planted, runs, sha, without_runs, words

from snowloom.llm import periodic
from snowloom.llm.queries import QUERIES
from snowloom.llm.registry import prepare
from snowloom.llm.substrings import word_codes

FOLDER = f"/root/testdata/{os.environ.get('TEST_SF', 'sf0.001')}"
SCHEMA = "doc_id long, text string, runs string, n_words int, strongest double"


def pieces(rng):
    """Words made of cycles, cut anywhere, some of them repeated as a whole."""
    kinds, out = rng.choice([1, 2, 2, 3, 5, 50]), []
    for _ in range(rng.randint(1, 6)):
        unit = [str(rng.randrange(kinds)) for _ in range(rng.randint(1, rng.choice([3, 12, 40])))]
        length = rng.randint(1, len(unit) * rng.randint(1, 6))
        out += (unit * 7)[:length]
        if rng.random() < 0.3:
            out += out[: rng.randint(0, len(out))]
    return out[:400]


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_a_direct_search(seed):
    rng, met = random.Random(seed), 0
    for _ in range(120):
        w = pieces(rng)
        text = " ".join(w).encode()
        want = runs(w)
        assert periodic.runs(text.split(), word_codes(text)) == want, w
        met += len(want)
    assert met > 20


def test_automaton_alone():
    """Without the stretches: the automaton over a whole text finds the same runs."""
    rng = random.Random(11)
    for _ in range(60):
        w = pieces(rng)
        whole, periodic_stretches = [(0, len(w))], periodic.stretches
        try:
            periodic.stretches = lambda codes: whole
            assert periodic.runs(w, word_codes(" ".join(w).encode())) == runs(w)
        finally:
            periodic.stretches = periodic_stretches


def test_long_run_in_linear_time():
    unit = [f"w{i}" for i in range(5_000)]
    text = " ".join(["x", *(unit * 8), "y"]).encode()
    assert periodic.runs(text.split(), word_codes(text)) == [(1, 40_000, 5_000)]


def odd_texts():
    cycle = " ".join(["ab", "cd", "ef"] * 9)
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "a " * 23), (6, "a\t" * 24), (7, cycle), (7, cycle), (None, cycle),
        (8, "a " * 24 + "b " * 30 + "a " * 24), (9, " ".join(["a"] * 12 + ["b"]) + " " + " ".join((["a"] * 12 + ["b"]) * 3)),
        (10, "\u00a0 " * 30 + "\u2003x"), (11, " ".join(str(i) for i in range(30_000)) + " " + "z y " * 500),
    ]


def test_odd_rows(spark):
    prepare(spark)
    texts = odd_texts()
    docs = spark.createDataFrame([(d, t, "x", -1, 0.5) for d, t in texts], SCHEMA).repartition(3)
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.strongest and tuple(r.strongest), r.collapsed) for r in periodic.find_runs(docs).collect()), key=str)
    want = []
    for d, t in texts:
        w = words(t)
        found = runs(w) if len(w) < 1_000 else [(30_000, 1_000, 2)]
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        want.append((d, len(w), found, best, without_runs(w, found)))
    assert got == sorted(want, key=str)
    assert periodic.find_runs(docs.where("doc_id < 0")).collect() == []


def test_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want, met = [], 0
    for d, t in docs:
        w = planted(words(t), d)
        if len(w) > 3_000:
            continue
        found = runs(w)
        met += bool(found)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        row = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((d, len(found), *row, sha(lines), sha(without_runs(w, found))))
    ids = {r[0] for r in want}
    rows = QUERIES["op12_periodic_runs"](spark, FOLDER).collect()
    assert len(rows) == len(docs) and met > 5
    assert sorted(tuple(r) for r in rows if r.doc_id in ids) == sorted(want)
