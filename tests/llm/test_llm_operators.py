"""Odd inputs of the training-data operators: nulls, empty and very long texts, ties, repeats, no rows."""

import html
import time

import numpy as np
import public_tokenizers
import pytest
from brute import groups, sha, simhash, token_rows, without_repeats
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snowloom.llm import chat, components, decontaminate, licenses, minhash, mixing, quality, simhash as sim, substrings, token_files, toxicity
from snowloom.llm.registry import prepare
from snowloom.session import materialize

LONG = " ".join(f"w{i % 4001}x{i % 37}" for i in range(60_000))
PASSAGE = " ".join(f"p{i}" for i in range(50))
ITEM = "which river of the old valley carries most water in spring answer: the green one of course"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, size long, score double, found int"


def filler(seed, n=60):
    return " ".join(f"f{x}" for x in np.random.default_rng(seed).integers(0, 10_000, n))


def odd_rows():
    texts = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "One two"), (6, LONG), (7, LONG + " end"),
        (8, filler(1) + " " + PASSAGE), (9, PASSAGE + " " + filler(2)), (10, filler(3)), (10, filler(3)), (10, filler(3)),
        (None, filler(4)), (None, filler(7)), (None, None), (11, f"{filler(5)} {ITEM.title()}! {filler(6)}"),
        (12, "Released under the MIT License. Apache license"), (13, "Él \U0001f600 ñ <s>[INST] & K"), (14, "a " * 300),
    ]
    return [(d, t, "en", None if (d or 0) % 5 == 0 else f"s{(d or 0) % 3}", None, "r", -1, 2.0, 7) for d, t in texts]


@pytest.fixture(scope="module")
def odd(spark):
    prepare(spark)
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("doc_id < 0")


@pytest.fixture(scope="module")
def labels(spark):
    marks = [(d, d % 2, int(d in (4, 9))) for d in range(1, 15)] + [(10, 1, 0), (None, 1, 1), (99, 0, 1), (1, None, None)]
    return spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def key(row):
    return tuple((x is not None, x) for x in row)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def texts():
    return [(r[0], r[1]) for r in odd_rows()]


def test_simhash(odd, none):
    prints = [simhash(t) for _, t in texts()]
    want = [(d, f"{p:016x}", g) for (d, _), p, g in zip(texts(), prints, groups(prints, [d for d, _ in texts()]))]
    assert collected(sim.near_duplicates(odd)) == sorted(want, key=key)
    assert sim.near_duplicates(none).count() == 0
    kept = sim.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    # Two groups have rows without an id alone.
    assert ids.count(None) == 2 and sorted({i for i in ids if i}) == sorted(i for i in ids if i)
    assert set(ids) == {g for _, _, g in want}


def test_links_of_a_full_key(spark):
    """Fingerprints that share a key beyond the limit for pairs are linked all the same."""
    rng = np.random.default_rng(7)
    base = int(rng.integers(1 << 62))
    prints = sorted({base ^ int(sum(1 << int(b) for b in rng.choice(8, rng.integers(0, 8), replace=False))) for _ in range(200)})
    prints += [int(x) for x in rng.integers(0, 1 << 62, 50)]
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    for paired in (2, 64):
        got = components.components(sim.links(frame, paired))
        roots = {r.node: r.root for r in got.collect()}
        assert [roots.get(p, p) for p in prints] == groups(prints, prints)


def test_components_of_a_chain(spark):
    n = 300
    chain = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(1000, 1400).select(F.lit(1399).cast("long").alias("a"), F.col("id").alias("b"))
    roots = {r.node: r.root for r in components.components(chain.unionByName(star)).collect()}
    assert {roots[i] for i in range(n + 1)} == {0} and {roots[i] for i in range(1000, 1400)} == {1000}


@pytest.mark.parametrize("window", [5, 35, 48])
def test_substrings(odd, window):
    want = [(d, n, g, kept) for (d, _), (n, g, kept) in zip(texts(), without_repeats([t for _, t in texts()], window))]
    got = substrings.remove_repeats(odd, window)
    assert collected(got.select("doc_id", "n_words", "n_removed", "kept")) == sorted(want, key=key)
    for r in got.where("n_removed > 0").collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_substrings_of_no_rows(none):
    assert substrings.remove_repeats(none).count() == 0


def test_window_levels():
    assert substrings.levels(35) == [9, 18, 35]
    for window in range(1, 200):
        lengths = substrings.levels(window)
        assert lengths[-1] == window and all(b <= 2 * a for a, b in zip(lengths, lengths[1:]))


def test_classifiers(odd, none, labels):
    for score in (lambda d, m: toxicity.score(d, m), lambda d, m: quality.score(d, m).select("row.doc_id", "held_out", "score", "predicted")):
        got = score(odd, labels).collect()
        assert sorted((r.doc_id is not None, r.doc_id) for r in got) == sorted((d is not None, d) for d, _ in texts())
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
        assert score(none, labels).count() == 0
        assert all(0 <= r.score <= 1 for r in score(odd, labels.where("doc_id < 0")).collect())
    assert quality.keep_good(odd, labels).columns == odd.columns


def test_labels_held_out_are_not_read(odd, labels):
    """Other labels in the held-out fold change no score."""
    for score, folds, held, name in ((toxicity.score, 4, 2, "toxic"), (quality.score, 5, 0, "quality")):
        turned = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held, 1 - F.col(name)).otherwise(F.col(name))
        a = [r.score for r in score(odd, labels).collect()]
        b = [r.score for r in score(odd, labels.withColumn(name, turned)).collect()]
        assert sorted(a) == pytest.approx(sorted(b))


def test_rare_expressions_back_off(spark):
    """A word never seen is judged by how it begins."""
    toxic = [(i, f"the plain text with zorbl{i} and zorbl{i + 1}", 0, 1) for i in range(0, 400, 2)]
    plain = [(i, f"the plain text with glimt{i} and glimt{i + 1}", 1, 0) for i in range(1, 400, 2)]
    new = [(1000, "the plain text with zorblnew", 0, 0), (1001, "the plain text with glimtnew", 0, 0)]
    docs = spark.createDataFrame([(d, t) for d, t, *_ in toxic + plain + new], "doc_id long, text string")
    marks = spark.createDataFrame([(d, q, t) for d, _, q, t in toxic + plain], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(docs, marks).where("doc_id >= 1000").collect()}
    assert got[1000] > 0.9 and got[1001] < 0.1


def test_fingerprints(odd, none):
    got = minhash.edited_pairs(odd).collect()
    order = sorted(texts(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(got) == len(order)
    assert sorted(r.n_chars for r in got) == sorted(len(t or "") for _, t in order)
    for r in got:
        assert (r.fingerprint == r.edited_fingerprint) <= (r.near_edited == 1.0)
    same = {r.fingerprint for r in got if r.doc_id == 10}
    assert len(same) == 1
    empty = [r for r in got if r.n_chars == 0]
    assert len({r.fingerprint for r in empty}) == 1 and all(r.edited_sha256 == sha("") for r in empty)
    assert minhash.edited_pairs(none).count() == 0
    one = minhash.edited_pairs(odd.where("doc_id = 6")).collect()[0]
    assert one.near_next == 1.0 and one.edited_sha256 == sha(LONG[: len(LONG) - len(LONG) // 4] + LONG[: len(LONG) // 4])


def test_estimates_are_unbiased(spark):
    rng = np.random.default_rng(3)
    pairs = []
    for i in range(150):
        n, shared = int(rng.integers(8, 400)), float(rng.random())
        base = [f"{i}a{j}" for j in range(n)]
        cut = int(n * shared)
        pairs.append((" ".join(base), " ".join(base[:cut] + [f"{i}b{j}" for j in range(n - cut)])))
    from brute import jaccard

    frame = spark.createDataFrame(pairs, "a string, b string")
    near = minhash.likeness(minhash.signature(F.col("a")), minhash.signature(F.col("b")))
    errors = [r.near - jaccard(r.a, r.b) for r in frame.select("a", "b", near.alias("near")).collect()]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


def test_mixing(odd, none, spark):
    mixed = mixing.mix(odd)
    got = mixed.select("row.doc_id", "row.source", mixed["size"], "source_size", "target", "taken").collect()
    assert len(got) == len(texts()) and all(0 <= r.taken <= 3 * r["size"] for r in got)
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert sum(r["size"] for r in own) == own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.5
    again = mixing.mix(odd.repartition(7))
    assert collected(again.select("row.doc_id", "taken")) == collected(mixed.select("row.doc_id", "taken"))
    copies = mixing.repeated(mixed)
    assert copies.columns == odd.columns
    words = {r.doc_id: r.n for r in copies.groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(r"\S+"))).alias("n")).collect()}
    for doc_id in (6, 8, 9):
        assert words.get(doc_id, 0) == sum(r.taken for r in got if r.doc_id == doc_id)
    assert mixing.mix(none).count() == 0


def test_water_filling(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1), (None, 300), ("d", 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    level = (1311 - 30 - 3) / (2 + 2)
    assert got["a"] == 30 and got["c"] == 3 and got["d"] == 0
    assert got["b"] == pytest.approx(2 * level) and got[None] == pytest.approx(2 * level)


def test_rare_toxic_words_keep_their_ratio_among_many_words(spark):
    prepare(spark)
    many = spark.range(400_000).select(F.concat(F.lit("zorb"), "id").cast("binary").alias("word"), F.lit(9).cast("long").alias("o"), F.lit(0).cast("long").alias("t"))
    rare = spark.range(100).select(F.concat(F.lit("zorbx"), "id").cast("binary").alias("word"), F.lit(0).cast("long").alias("o"), F.lit(3).cast("long").alias("t"))
    tables = toxicity.fit(many.union(rare))
    ratios = toxicity.LogRatios(tables)
    # A word that was not counted has the ratio of its beginning.
    beginning = ratios[b"zorbxunseen"]
    assert sum(ratios[b"zorbx%d" % i] == beginning for i in range(100)) == 0
    assert len(tables[0]["names"]) == 400_100


def test_decontamination(odd, none, spark):
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, "..."), (4, "words that stand nowhere in any text at all")], "item_id long, text string")
    got = decontaminate.find(odd, items)
    assert got.count() == len(texts())
    assert [(r.row.doc_id, [x.item_id for x in r.found]) for r in got.where(F.size("found") > 0).collect()] == [(11, [1])]
    kept = decontaminate.keep_clean(odd, items)
    assert kept.columns == odd.columns and kept.count() == len(texts()) - 1
    assert decontaminate.find(none, items).count() == 0
    assert decontaminate.keep_clean(odd, items.where("item_id > 9")).count() == len(texts())


def test_paraphrases_need_the_answer(spark):
    question, reply = "in which year did the northern station first send its long signal over the mountains", "nineteen twelve in june"
    reworded = question.replace("northern", "upper").replace("first", "begin to").replace("long", "strong").replace("over", "across")
    rows = [(1, f"{filler(1)} {reworded}? {reply} {filler(2)}"), (2, f"{filler(3)} {reworded}? never {filler(4)}"), (3, filler(5))]
    docs = spark.createDataFrame(rows + [(i, filler(i, 200)) for i in range(10, 60)], "doc_id long, text string")
    items = spark.createDataFrame([(7, f"{question}? {reply}")], "item_id long, text string")
    assert [r.row.doc_id for r in decontaminate.find(docs, items).where(F.size("found") > 0).collect()] == [1]


def reworded(item, rng):
    """Half of an item's words with its answer, the rest and all around it unknown to the benchmark."""
    n, reply = len(item.words), item.answer
    begin = next(i for i in range(n, -1, -1) if item.words[i : i + len(reply)] == reply)
    kept = set(range(begin, begin + len(reply)))
    others = [i for i in range(n) if i not in kept]
    kept |= set(rng.choice(others, max(0, -(-n // 2) - len(kept)), replace=False).tolist())
    words = [w.decode() if i in kept else f"q{rng.integers(1000)}" for i, w in enumerate(item.words)]
    return " ".join([filler(n, 50), *words, filler(n + 1, 50)])


@pytest.mark.parametrize("copies", [1, 40])
def test_every_paraphrase_is_found_in_small_and_large_corpora(spark, copies):
    """Words around an item and words that a corpus adds lower every cosine, but lose no paraphrase or copy."""
    prepare(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    docs = docs.crossJoin(spark.range(copies)).select("text")
    rows = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").orderBy("item_id").collect()
    items = [decontaminate.Item(r.item_id, decontaminate.words(r.text), decontaminate.answer(r.text)) for r in rows]
    space, rng = decontaminate.fit(docs, items, [r.text for r in rows]), np.random.default_rng(3)
    texts = [reworded(i, rng) for i in items] + [f"{filler(1, 9)} {' '.join(w.decode() for w in i.words)} {filler(2, 9)}" for i in items]
    found = space.search(texts)
    missed = [(k // len(items), i.item_id) for k, i in enumerate(items * 2) if i.item_id not in [f[0] for f in found[k]]]
    assert len(items) >= 20 and missed == []


def test_axes_keep_the_items_energy(spark):
    """Of 200 items, more passages than axes, the space keeps what 144 axes keep."""
    prepare(spark)
    rows = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").orderBy("item_id").collect()
    items = [decontaminate.Item(r.item_id, decontaminate.words(r.text), decontaminate.answer(r.text)) for r in rows]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    space = decontaminate.fit(docs, items, [r.text for r in rows])
    b = decontaminate.Blocks.of([r.text for r in rows], space.known)
    length = b.paired(np.bincount(b.block[b.new], weights=space.squares[b.ids[b.new]], minlength=b.n))
    kept = ((b.paired(b.sums(space.projection)) ** 2).sum(axis=1) / length)[b.whole()]
    assert len(items) == 200 and space.projection.shape[1] >= 144
    assert kept.mean() > 0.52 and kept.min() > 0.32


def test_words_needed_are_necessary():
    """Whatever the verification accepts by words is a candidate, at every place in a text."""
    rng = np.random.default_rng(5)
    for _ in range(60):
        word = lambda n: [b"w%d" % x for x in np.minimum(rng.zipf(1.3, n), 40)]
        item = decontaminate.Item(0, (a := word(rng.integers(1, 50))), a[rng.integers(0, len(a)) :])
        item.energy = {w: 1 / len(set(a)) for w in a}
        known = {w: i for i, w in enumerate(sorted(set(a)))}
        text = [*word(rng.integers(0, 90)), *(w for w in a if rng.random() < 0.9), *word(rng.integers(0, 90))]
        b = decontaminate.Blocks.of([b" ".join(text).decode(), "w1", b" ".join(text).decode()], known)
        counts = np.bincount(b.ids, minlength=len(known)).astype(float)
        needed = decontaminate.Needed.of([item], known, counts, float(b.n))
        space = decontaminate.Space(known, None, None, 0.0, [item], np.zeros((1, 1)), np.zeros(1, int), needed)
        got, n = space.candidates(b, np.zeros((b.n, 1))), len(a)
        for row in np.flatnonzero(b.whole()).tolist():
            at = int(np.searchsorted(b.first, row, side="right")) - 1
            start = (row - int(b.first[at])) * decontaminate.BLOCK
            region = b.texts[at][max(0, start - n) : start + 2 * decontaminate.BLOCK + n]
            share, answered = item.shares(region)
            if share >= 0.8 or share >= 0.5 and answered >= 0.9 and item.telling(region) >= decontaminate.TELLING:
                assert (row, 0) in got


def test_common_subsequence():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = ([bytes([x]) for x in rng.integers(0, 5, rng.integers(1, 30))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        item = decontaminate.Item(0, a, [])
        assert decontaminate.common_subsequence(item.masks[0], len(a), b) == table[-1, -1]


def test_chat_parts(spark):
    image = ("image", None, "pic://1", 280, 140, None, None)
    parts = [("text", "see <|turn|> ", None, None, None, None, None), image, (None, "& more", None, None, None, None, None),
             ("audio", None, "snd://2", None, None, 2.5, None), ("document", None, "doc://3", None, None, None, 4), ("video", None, "v", None, None, None, None)]
    rows = [(1, 1, "assistant", [("text", "fine [x]", None, None, None, None, None)]), (1, 0, "us\ner", parts), (2, 0, None, None),
            (2, None, "assistant", []), (None, 0, "user", None), (3, 0, "assistant", [image]), (3, 0, "assistant", [image])]
    turns = spark.createDataFrame(rows, f"conv_id long, turn int, role string, parts array<{chat.PART}>")
    done = chat.format_chats(turns)
    got = {r.conv_id: r for r in chat.read_back(done).collect()}
    assert [(a.kind, a.ref, a.tokens) for a in got[1].attachments] == [("image", "pic://1", 50), ("audio", "snd://2", 63), ("document", "doc://3", 1024), ("video", "v", 0)]
    assert got[1].attachment_tokens == 1137 and got[1].n_turns == 2
    assert got[1].turns[0].role == "us\ner" and got[1].turns[1].text == "fine [x]" and got[1].loss_text == "fine [x]"
    assert got[1].formatted.count(chat.TURN) == 2 and "<|image|>&amp; more<|audio|><|document|><|attachment|>" in got[1].formatted
    assert len(got[2].loss) == 1 and got[2].loss_text == "" and [t.role for t in got[2].turns] == ["assistant", ""]
    assert got[3].n_turns == 2 and len(got[3].attachments) == 2 and None in got
    assert chat.format_chats(turns.where("conv_id > 9")).count() == 0


def test_loss_spans_are_places_in_the_text(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], f"{'é\U0001f600' * (t % 3)} <{t}> & [x]") for c in range(3) for t in range(9)]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("parts", chat.text_parts(F.col("text")))
    for r in chat.read_back(chat.format_chats(turns)).collect():
        pieces = r.formatted.split(chat.TURN)[1:]
        assert [p.turn for p in r.loss] == [1, 3, 5, 7]
        assert all(r.formatted[p.start : p.end] == pieces[p.turn][p.at : p.at + p.end - p.start] for p in r.loss)
        assert "".join(html.unescape(r.formatted[p.start : p.end]) for p in r.loss) == r.loss_text


def test_many_turns_are_read_in_proportion(spark):
    """Four times the turns take about four times as long, not sixteen times."""
    took = {}
    for n in (5_000, 5_000, 20_000):
        turns = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 1, "assistant").otherwise("user").alias("role"), chat.text_parts(F.repeat(F.lit("word "), 40)).alias("parts"))
        done = materialize(chat.format_chats(turns), "chat-test")
        start = time.perf_counter()
        r = chat.read_back(done).select(F.size("turns").alias("n"), F.length("loss_text").alias("chars")).first()
        took[n] = time.perf_counter() - start
        assert (r.n, r.chars) == (n, n // 2 * 200)
    assert took[20_000] < 5 * took[5_000] + 1


def test_chat_texts_come_back(spark, odd):
    turns = odd.select(F.col("doc_id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("assistant").alias("role"), chat.text_parts(F.col("text")).alias("parts"))
    got = chat.read_back(chat.format_chats(turns.where("conv_id <> 10"))).collect()
    want = {d: t or "" for d, t in texts()}
    assert {r.conv_id: r.loss_text for r in got} == {d: t for d, t in want.items() if d not in (10, None)}
    assert all(r.turns[0].text == r.loss_text for r in got)


def test_licenses(odd, none):
    got = licenses.scan(odd).collect()
    assert len(got) == len(texts())
    found = {r.doc_id: r for r in got if r.labels}
    assert set(found) == {12}
    r = found[12]
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == (7, 2, 3, 5, "apache,mit", "apache,mit")
    assert licenses.scan(none).count() == 0


def test_license_blocks_by_brute_force(spark):
    rng = np.random.default_rng(5)
    vocabulary = sorted({w for _, t in licenses.TEMPLATES for w in licenses.tokens(t)})
    rows = []
    for i in range(120):
        label, text = licenses.TEMPLATES[i % len(licenses.TEMPLATES)]
        held = [w for w in licenses.tokens(text) if rng.random() > 0.08]
        rows.append((i, " ".join([*rng.choice(vocabulary, 20), *held, *rng.choice(vocabulary, 30)])))
    matched(spark, rows)


def matched(spark, rows):
    """All labels of all windows, counted directly, against the operator's."""
    got = {}
    for r in licenses.block_matches(licenses.read_words(spark.createDataFrame(rows, "doc_id long, text string"))).collect():
        got.setdefault(r.doc_id, {})[r.label] = r.containment
    for i, text in rows:
        w, want = licenses.tokens(text), {}
        for s in range(max(len(w), 1)):
            block = set(w[s : s + licenses.BLOCK])
            for label, template in licenses.TEMPLATES:
                t = set(licenses.tokens(template))
                if len(block & t) >= licenses.THRESHOLD * len(t) - 1e-9:
                    want[label] = max(want.get(label, 0), len(block & t) / len(t))
        assert got.get(i, {}) == pytest.approx(want)
    return got


def test_license_blocks_begin_anywhere(spark):
    """Notices spread over up to a whole window, at every offset, are found, and one word more loses them."""
    notice = licenses.tokens(dict(licenses.TEMPLATES)["bsd"])
    spread = " ".join(f"{w} zz zz" for w in notice)
    rows = [(i, "zz " * i + spread + " zz" * 40) for i in range(0, 70, 3)]
    assert len(licenses.tokens(spread)) - 2 <= licenses.BLOCK
    got = matched(spark, rows)
    assert all("bsd" in got[i] for i, _ in rows)
    # The words it can do without stand inside, so the first and the last are needed and lie too far apart.
    far = [(0, " ".join(f"{w} " + "zz " * 4 for w in notice)), (1, "mit " * 500 + "license"), (2, ""), (3, None)]
    assert "bsd" not in matched(spark, [r for r in far if r[1] is not None]).get(0, {})


def test_token_files(odd, none, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    order = sorted(texts(), key=lambda r: (r[0] is not None, r[0] or 0))
    shards = token_files.write(odd, path, str(tmp_path / "a"), length=64)
    got = sorted((tuple(r) for r in token_files.read(shards).collect()), key=lambda r: r[1])
    want = token_rows(order, Tokenizer.from_file(path))
    assert [r[0] for r in got] == [r[0] for r in want] and sorted(r[2:] for r in got) == sorted(r[2:] for r in want)
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:]))
    first = shards.orderBy("shard").first()
    held = token_files.TokenFile(first.tokens)
    flat = np.concatenate(list(held.stream()))
    assert len(flat) == first.n_tokens and len(held) == -(-first.n_tokens // 64)
    for i in (0, len(held) // 2, len(held) - 1):
        ids, mask = held[i]
        assert len(ids) == len(mask) == 64 and np.array_equal(ids[np.array(mask)], flat[i * 64 : i * 64 + 64])
        batch = held.file.get_batch(i // token_files.ROWS)
        held_ids, held_masks = (batch.column(c).values.buffers()[1] for c in ("ids", "mask"))
        assert held_ids.address <= ids.__array_interface__["data"][0] < held_ids.address + held_ids.size
        assert mask.buffers()[1].address == held_masks.address and mask.offset % 64 == 0
    assert token_files.encode(none, path).count() == 0


def test_chunks_encode_as_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, encode = Tokenizer.from_file(path), token_files.Encoder(path)
    odd = ["a  b", "a \n b", " x", "x ", "", "  ", "\n a", "a  b", "<|endoftext|> x<|endoftext|>y", "don't  'll we'd", "a   b\t c",
           "x" * 3000 + " y " + "z " * 50, "\x1c a \x85 b", "é  è \U0001f600 ‍", "1 22 333", "a b\n", "a b\nc d"]
    assert encode.chunked
    for texts_ in (odd, odd[::-1], [" ".join(odd)], [], ["a"] * 3, ["  "]):
        ids, sizes = encode(texts_)
        got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] if len(texts_) else []
        assert got == [[*whole.encode(t, add_special_tokens=False).ids, 0] for t in texts_]


def test_chunks_outlive_a_generation(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, encode = Tokenizer.from_file(path), token_files.Encoder(path)
    monkeypatch.setattr(token_files, "_HELD_CHUNKS", 50)
    for k in range(12):
        text = " ".join(["often", *(f"w{k}x{i}" for i in range(30)), "seen"])
        assert encode([text])[0].tolist() == [*whole.encode(text, add_special_tokens=False).ids, 0]
    assert "seen" in encode.held and len(encode.held) < 120 and "w0x1" not in encode.older


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    whole, encode = Tokenizer.from_file(path), token_files.Encoder(path)
    assert not encode.chunked
    texts_ = ["One two  three", "", "Don't we\n\nknow", "x " * 300]
    ids, sizes = encode(texts_)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [[*whole.encode(t, add_special_tokens=False).ids, 0] for t in texts_]
