"""License scans: an exact set-similarity join of text blocks with license templates, beside fixed phrases.

Native: Spark's own functions only.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snowloom.llm.native import inline_rows, let
from snowloom.session import materialize

# A word is a run of ASCII letters, digits and anything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Label and wording of license notices.
TEMPLATES: Sequence[tuple[str, str]] = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction"),
    ("mit", "Released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may not use this file except in compliance with the Apache License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by", "Licensed under the Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "Licensed under the Creative Commons Attribution NonCommercial 4.0 International License"),
)
# Phrases and labels that are always reported.
PHRASES: Sequence[tuple[str, str]] = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
THRESHOLD = 0.9
# A block is a window of this many words, wherever it begins.
BLOCK = 64


def tokens(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORD), F.lit(0))


def _vocabulary(templates: Sequence[tuple[str, str]]) -> list[str]:
    return sorted({w for text in [t for _, t in templates] + [p for p, _ in PHRASES] for w in tokens(text)})


def read_words(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``(doc_id, tie, n_words, hits)``: the words of each text that a template or phrase has, with their places.

    Texts are cut into words here and nowhere else; all that follows is found from the hits.
    """
    known = _vocabulary(templates)

    def found(w: Column) -> Column:
        hits = F.filter(F.transform(w, lambda x, i: F.when(x.isin(known), F.struct(i.alias("at"), x.alias("token")))), lambda h: h.isNotNull())
        return F.struct(F.size(w).cast("long").alias("n_words"), hits.alias("hits"))

    read = docs.select("doc_id", F.xxhash64("text").alias("tie"), let(words(F.col("text")), found).alias("f"))
    return materialize(read.select("doc_id", "tie", "f.n_words", "f.hits"), "license-words")


def _phrase_places(hits: Column, phrase: str, label: str) -> Column:
    """Label and start of every place where the words of a phrase stand one after the other, so their hits do too."""
    *before, last = phrase.split(" ")
    n = len(before)
    ends = F.filter(F.transform(hits, lambda h, i: F.when(h["token"] == last, i)), lambda i: i.isNotNull())

    def stands(i: Column) -> Column:
        def at(d: int, word: str) -> Column:
            h = F.get(hits, i - d)
            return F.coalesce((h["token"] == word) & (h["at"] == F.get(hits, i)["at"] - d), F.lit(False))

        return reduce(and_, [at(d, x) for d, x in enumerate(before[::-1], 1)])

    return F.transform(
        F.filter(ends, stands), lambda i: F.struct(F.lit(label).alias("label"), (F.get(hits, i)["at"] - n).cast("long").alias("start"))
    )


def _frequencies(read: DataFrame) -> dict[str, int]:
    """In how many documents each word of the templates stands: one row per template word."""
    held = read.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["token"]))).alias("token"))
    return {r.token: r.n for r in held.groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}


def _blocks(hits: Column, anchors: list[str], ordered: list[str], fewest: int) -> Column:
    """The sets of template words of all windows that could meet a template, each in the order of ``ordered``.

    A window that meets a template has one of its ``anchors``, and may as well begin at its first hit. So windows are
    opened at the hits up to ``BLOCK`` words before each anchor; as hits, these are as many at most.
    """
    at = lambda i: F.get(hits, i)["at"]
    places = F.filter(F.transform(hits, lambda h, i: F.when(h["token"].isin(anchors), i)), lambda i: i.isNotNull())
    opened = F.transform(places, lambda m: F.filter(F.sequence(F.greatest(m - (BLOCK - 1), F.lit(0)), m), lambda i: at(i) > at(m) - BLOCK))
    known = F.array(*map(F.lit, ordered))

    def block(i: Column) -> Column:
        inside = F.filter(F.slice(hits, i + 1, BLOCK), lambda h: h["at"] < at(i) + BLOCK)
        return F.array_intersect(known, F.transform(inside, lambda h: h["token"]))

    sets = F.transform(F.array_distinct(F.flatten(opened)), block)
    return F.array_distinct(F.filter(sets, lambda b: F.size(b) >= fewest))


def _template_prefixes(spark: SparkSession, sets: list[tuple[str, list[str], int]]) -> DataFrame:
    """One row per template and word of its prefix. Templates are a list in code, which bounds the frame."""
    rows = [
        (n, label, held, len(held), least, i, held[i])
        for n, (label, held, least) in enumerate(sets)
        for i in range(len(held) - least + 1)
    ]
    return inline_rows(spark, rows, "template int, label string, held array<string>, n_held int, least int, i int, token string")


def block_matches(read: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, tie, label, containment)``: every label some block of a document meets, and how well.

    ``read`` is what ``read_words`` gives. Every window of ``BLOCK`` words is a block; it meets a template if it holds at
    least ``threshold`` of the template's distinct words. Words no template has cannot count, so a block is reduced to its
    template words, in the global order of their document frequency, rarest first. Two sets that share ``least`` words
    share one among the first ``n - least + 1`` of each (prefix filter), so windows without any template's are never
    opened; blocks with fewer words cannot meet it (length filter); nor can pairs whose words after the shared
    one are too few (positional filter). The rest is counted.
    """
    spark = read.sparkSession
    raw = [(label, set(tokens(text))) for label, text in templates]
    vocabulary = sorted(set().union(*(held for _, held in raw)))
    seen = _frequencies(read)
    ordered = sorted(vocabulary, key=lambda t: (seen.get(t, 0), t))
    place = {t: i for i, t in enumerate(ordered)}
    sets = [(label, sorted(held, key=place.get), math.ceil(round(threshold * len(held), 9))) for label, held in raw]
    fewest = min(least for _, _, least in sets)
    anchors = sorted({t for _, held, least in sets for t in held[: len(held) - least + 1]})

    found = F.explode(let(F.col("hits"), lambda h: _blocks(h, anchors, ordered, fewest))).alias("block")
    held = read.where(F.exists("hits", lambda h: h["token"].isin(anchors))).select("doc_id", "tie", found)
    parts = held.select("*", F.size("block").alias("n_block"), F.posexplode("block").alias("j", "token"))
    prefixes = _template_prefixes(spark, sets)
    left = F.col("n_block") - F.col("j")
    pairs = parts.join(F.broadcast(prefixes), "token").where(
        (F.col("n_block") >= F.col("least"))
        & (left >= F.col("least"))
        & (F.least(F.col("n_held") - F.col("i"), left) >= F.col("least") - F.least(F.col("i"), F.col("j")))
    )
    shared = F.size(F.array_intersect("block", "held"))
    counted = pairs.select("doc_id", "tie", "label", "least", shared.alias("shared"), "n_held").where("shared >= least")
    return counted.groupBy("doc_id", "tie", "label").agg(F.max(F.col("shared") / F.col("n_held")).alias("containment"))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts the places of the fixed phrases, ``first_word`` and ``last_word`` are the least and the
    greatest word they start at. ``labels`` has the phrases' labels and those of the templates met, distinct,
    sorted and comma-joined; ``score`` is 1 with a phrase, else the best containment that meets the
    threshold, else 0. A null text is empty; repeated rows stay; an empty table gives no rows.
    """

    read = read_words(docs)
    places = let(F.col("hits"), lambda h: F.concat(*[_phrase_places(h, *p) for p in PHRASES]))
    none = F.array().cast("array<struct<label:string,start:bigint>>")
    ends = [phrase.split(" ")[-1] for phrase, _ in PHRASES]
    base = read.select("doc_id", "tie", "n_words", F.when(F.exists("hits", lambda h: h["token"].isin(ends)), places).otherwise(none).alias("places"))
    met = block_matches(read).groupBy("doc_id", "tie").agg(
        F.collect_set("label").alias("met"), F.max("containment").alias("best")
    )
    met = materialize(met, "license-blocks").select(F.col("doc_id").alias("d"), F.col("tie").alias("t"), "met", "best")
    joined = base.join(met, base.doc_id.eqNullSafe(met.d) & (base.tie == met.t), "left")
    starts = F.transform("places", lambda p: p["start"])
    base_labels = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    both = F.array_sort(F.array_union(base_labels, F.coalesce("met", F.array().cast("array<string>"))))
    return joined.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def _sql() -> str:
    def quoted(xs: Sequence[str]) -> str:
        return "[" + ", ".join(f"'{x}'" for x in xs) + "]"

    rows = []
    for label, text in TEMPLATES:
        held = sorted(set(tokens(text)))
        rows.append(f"('{label}', {quoted(held)}, {len(held)}, {math.ceil(round(THRESHOLD * len(held), 9))})")
    places = []
    for phrase, label in PHRASES:
        parts = phrase.split(" ")
        stands = " AND ".join(f"w[i + {d}] = '{x}'" for d, x in enumerate(parts, 1))
        places.append(f"list_transform(list_filter(range(0, len(w) - {len(parts) - 1}), lambda i: {stands}), lambda i: {{'label': '{label}', 'start': i}})")
    return f"""
WITH t(label, held, n_held, least) AS (VALUES {", ".join(rows)}),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS w FROM documents),
b AS (SELECT doc_id, list_distinct(w[s + 1 : s + {BLOCK}]) AS block
      FROM (SELECT doc_id, w, unnest(list_filter(range(0, len(w)), lambda i: list_contains({quoted(_vocabulary(TEMPLATES))}, w[i + 1]))) AS s FROM d)),
m AS (SELECT doc_id, label, max(len(list_intersect(block, held)) / n_held) AS containment
      FROM b, t WHERE len(list_intersect(block, held)) >= least GROUP BY doc_id, label),
x AS (SELECT doc_id, list(label) AS met, max(containment) AS best FROM m GROUP BY doc_id),
p AS (SELECT doc_id, len(w) AS n_words, {" || ".join(places)} AS places FROM d),
q AS (SELECT p.*, x.met, x.best, list_transform(places, lambda p: p.start) AS starts,
             list_sort(list_distinct(list_transform(places, lambda p: p.label))) AS base
      FROM p LEFT JOIN x ON p.doc_id = x.doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
       list_min(starts) AS first_word, list_max(starts) AS last_word,
       coalesce(array_to_string(base, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(base, coalesce(met, [])))), ','), '') AS labels,
       CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM q
"""


SQL = _sql()
