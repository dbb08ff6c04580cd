"""The registered queries of the training-data operators against SQL, brute force or held-out labels."""

import os

import public_tokenizers
import pytest
from brute import edited, groups, jaccard, sha, simhash, token_rows, without_repeats
from compare import connect, differences
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
from snowloom.llm import minhash
from snowloom.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata"
TABLES = "documents labels benchmark conversations pages embeddings".split()
FOLDER = f"{DATA}/{os.environ.get('TEST_SF', 'sf0.001')}"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER, TABLES)


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def rows(spark, name, folder=FOLDER):
    return sorted(tuple(r) for r in QUERIES[name](spark, folder).collect())


def test_registered():
    numbers = {int(n[2:].split("_")[0]) for n in QUERIES}
    assert numbers == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, ORACLES[name]) == []


def test_simhash(spark, docs):
    prints = [simhash(t) for _, t in docs]
    want = groups(prints, [d for d, _ in docs])
    assert rows(spark, "op1_simhash_near_dedup") == [(d, f"{p:016x}", c) for (d, _), p, c in zip(docs, prints, want)]


def test_decontamination(spark, con, docs):
    def norm(text):
        return " " + " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split()) + " "

    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    want = {d for d, t in docs for _, i in items if norm(i) in norm(t)}
    got = rows(spark, "op2_benchmark_decontamination")
    assert [r[0] for r in got] == [d for d, _ in docs]
    assert {r[0] for r in got if r[1]} == want


def test_substrings(spark, docs):
    want = without_repeats([t for _, t in docs], 35)
    assert sum(n for _, n, _ in want) > 0
    assert rows(spark, "op3_substring_dedup") == [(d, n, gone, sha(kept)) for (d, _), (n, gone, kept) in zip(docs, want)]


@pytest.mark.parametrize("name, label, folder", [("op4_toxicity", "toxic", "sf0.1"), ("op8_quality_classifier", "quality", "sf0.01")])
def test_classifiers(spark, name, label, folder):
    got = {r.doc_id: r for r in QUERIES[name](spark, f"{DATA}/{folder}").collect()}
    marks = spark.read.parquet(f"{DATA}/{folder}/labels.parquet").collect()
    held = [(got[m.doc_id], m[label]) for m in marks if got[m.doc_id].held_out]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert sum(r.predicted == y for r, y in held) / len(held) > 0.95
    ones = [r.predicted for r, y in held if y == 1]
    assert sum(ones) / len(ones) > 0.85


def test_fingerprints(spark, docs):
    got = rows(spark, "op5_minhash_fingerprints")
    texts = [t for _, t in docs]
    following = texts[1:] + texts[:1]
    errors = []
    for (doc_id, text), after, (got_id, n, digest, own, other, near_edited, near_next) in zip(docs, following, got):
        changed = edited(text, after)
        assert (got_id, n, digest) == (doc_id, len(text), sha(changed))
        assert len(own) == len(other) == minhash.BINS * minhash.KEPT_BITS // 4
        errors += [near_edited - jaccard(text, changed), near_next - jaccard(text, after)]
    assert max(map(abs, errors)) < 0.3 and abs(sum(errors) / len(errors)) < 0.01


def test_token_files(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert rows(spark, "op10_token_files") == token_rows(docs, tokenizer)


def test_pipeline(spark, con, docs):
    """The stages by brute force behind the classifier, whose verdicts are taken from its own query."""
    kept = {r[0] for r in rows(spark, "op8_quality_classifier") if r[3] == 1}
    texts = [(d, t) for d, t in docs if d in kept]
    group = groups([simhash(t) for _, t in texts], [d for d, _ in texts])
    leaks = {r[0] for r in rows(spark, "op2_benchmark_decontamination") if r[1]}
    left = {d for (d, _), g in zip(texts, group) if d == g and d not in leaks}
    got = entry_points.queries()["pipeline"](spark, FOLDER).collect()
    tokens = {r[0]: r[2:] for r in token_rows(docs, Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))}
    assert {r.doc_id for r in got} <= left
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    cut = [(d, r) for d, found in by_id.items() for r in found if r != tokens[d]]
    sources = dict(con.execute("SELECT doc_id, source FROM documents").fetchall())
    # At most one document of a source is taken in part.
    assert len({sources[d] for d, _ in cut}) == len(cut) and all(len(found) <= 4 for found in by_id.values())
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in in_order] == sorted(r.doc_id for r in got)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(in_order, in_order[1:]))
