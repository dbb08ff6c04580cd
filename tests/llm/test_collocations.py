"""Collocations against direct counting: generated texts, small portions, odd rows, the registered query."""

import os
import random

import pytest
from brute import collocations as direct

from snowloom.llm import collocations
from snowloom.llm.queries import QUERIES
from snowloom.llm.registry import prepare

FOLDER = f"/root/testdata/{os.environ.get('TEST_SF', 'sf0.001')}"
SCHEMA = "doc_id long, text string, lang string, n long, phrase int, word string"


def generated(seed):
    """Few words, many repeats, every kind of cut, also at both ends and side by side."""
    rng = random.Random(seed)
    words = ["The", "of", "ä", "b'c", "x-y", "zz q", "Ω", "e"]
    out = []
    for i in range(60):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", ";;", ": "]) for _ in range(rng.randint(0, 120)))
        out.append((i, text, rng.choice(["en", "en", "de", None])))
    out += [(90, "one Common line that is the same", "en")] * 40
    return out + [(91, None, "en"), (92, "", None), (93, " .;\n\t", "fr"), (94, "alone", "fr"), (None, "of the of the of the", None)]


def frame(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(d, t, lang, -1, -1, "w") for d, t, lang in rows], SCHEMA)


def got(found):
    rows = [tuple(r) for r in found.select("lang", "phrase", "a", "l", "r", "n", "score").collect()]
    return sorted(rows, key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))


@pytest.mark.parametrize("seed, longest, least, contained", [(1, 4, 12, 80), (2, 4, 3, 50), (3, 3, 5, 100), (4, 5, 10, 80)])
def test_equal_to_direct_counting(spark, seed, longest, least, contained):
    rows = generated(seed)
    want = direct([(lang, t) for _, t, lang in rows], longest, least, contained)
    assert len(want) > 5
    assert got(collocations.mine(frame(spark, rows).repartition(3), longest, least, contained)) == want


def test_small_portions(spark, monkeypatch):
    """Long texts are parted at cuts, and edges are summed over few words, without a change in the counts."""
    rows = [(1, "a b, c d. " * 400 + "e f g " * 300, "en"), (2, "x y z w " * 200, "en"), *generated(5)]
    monkeypatch.setattr(collocations, "CUT_BYTES", 64)
    portions = list(collocations._portions([t.encode() if t else None for _, t, _ in rows], [lang or "und" for _, _, lang in rows]))
    assert len(portions) > 20
    monkeypatch.undo()
    whole = collocations.HELD_WORDS
    try:
        collocations.HELD_WORDS = 100
        assert got(collocations.mine(frame(spark, rows))) == direct([(lang, t) for _, t, lang in rows], 4, 30, 80)
    finally:
        collocations.HELD_WORDS = whole


def test_portions_keep_pieces():
    text = ("ab cd, " * 50 + "x" * 300 + " y").encode()
    old, collocations.CUT_BYTES = collocations.CUT_BYTES, 20
    try:
        parts = [p for held, _ in collocations._portions([text, None, b"", b"q r"], ["a", "b", "c", "d"]) for p in held]
    finally:
        collocations.CUT_BYTES = old
    assert b"".join(parts) == text + b"q r"
    assert all(p[-1:] in b",." or p == parts[-1] or p.endswith(b"y") for p in parts)


def test_equal_keys_are_told_apart():
    """Rows that differ are never summed, whatever their sorting key."""
    import numpy as np

    a, b = np.array([1, 2, 1, 2, 1], np.uint64), np.array([5, 6, 5, 7, 5], np.uint64)
    order, begins = collocations._groups([a, b], np.zeros(5, np.uint64))
    groups = [sorted(map(int, g)) for g in np.split(order, begins[1:])]
    assert sorted(groups) == [[0, 2, 4], [1], [3]]


def test_no_rows(spark):
    docs = frame(spark, generated(1)[:1])
    assert collocations.mine(docs.where("doc_id < 0")).collect() == []
    assert collocations.mine(frame(spark, [(1, None, None), (2, " ", "en")])).collect() == []
    with pytest.raises(ValueError):
        collocations.mine(docs, longest=2)


def test_ranks(spark):
    rows = [("en", f"p{i % 7}{i}", i % 3, 1, 1, 9, i % 5) for i in range(500)]
    found = spark.createDataFrame(rows, "lang string, phrase string, a long, l long, r long, n long, score long")
    first = sorted((r.rank, r.phrase) for r in collocations.strongest(found, 40).collect())
    want = sorted(rows, key=lambda r: (-r[6], -r[2], r[1].encode()))[:40]
    assert first == [(i + 1, r[1]) for i, r in enumerate(want)]


def test_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("lang", "text").collect()
    want, ranks = [], {}
    for lang, *rest in direct([tuple(r) for r in docs], 4, 30, 80):
        ranks[lang] = ranks.get(lang, 0) + 1
        if ranks[lang] <= 2000:
            want.append((lang, ranks[lang], *rest))
    assert len(want) > 30
    assert sorted(tuple(r) for r in QUERIES["op13_collocations"](spark, FOLDER).collect()) == sorted(want)
