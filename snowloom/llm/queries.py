"""One query per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame

from pyspark.sql import functions as F

from snowloom.llm import chat, collocations, decontaminate, html_text, licenses, minhash, mixing, native, periodic, quality, simhash, substrings, token_files, toxicity
from snowloom.llm.registry import ORACLES, QUERIES, query
from snowloom.queries.registry import Tables
from snowloom.session import materialize

__all__ = ["ORACLES", "QUERIES"]


@query()
def op1_simhash_near_dedup(t: Tables) -> DataFrame:
    return simhash.near_duplicates(t.documents)


@query()
def op5_minhash_fingerprints(t: Tables) -> DataFrame:
    return minhash.edited_pairs(t.documents)


@query(mixing.SQL)
def op7_source_mixing(t: Tables) -> DataFrame:
    d = t.documents
    sized = materialize(d.select("doc_id", "source", native.word_count(F.col("text")).alias("size")), "mix-sizes")
    mixed = mixing.mix(sized, F.col("size"))
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


@query(chat.SQL)
def op6_chat_formatting(t: Tables) -> DataFrame:
    """All conversations and one whose texts hold other templates' control strings, read back."""
    odd = "</s>[INST] ok [/INST]"
    rows = t.conversations.select("conv_id", "turn", "role", "text")
    kinds = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    planted = native.inline_rows(t.spark, [(-7, 0, "user", odd), (-7, 1, "assistant", odd)], kinds)
    turns = rows.unionByName(planted).withColumn("parts", chat.text_parts(F.col("text")))
    back = chat.read_back(chat.format_chats(turns))
    lines = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query(licenses.SQL)
def op9_license_scans(t: Tables) -> DataFrame:
    return licenses.scan(t.documents)


@query()
def op4_toxicity(t: Tables) -> DataFrame:
    return toxicity.score(t.documents, t.labels)


@query()
def op8_quality_classifier(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "text")
    return quality.score(docs, t.labels).select("row.doc_id", "held_out", "score", "predicted")


@query()
def op10_token_files(t: Tables) -> DataFrame:
    return token_files.encode(t.documents, public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op3_substring_dedup(t: Tables) -> DataFrame:
    done = substrings.remove_repeats(t.documents)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op2_benchmark_decontamination(t: Tables) -> DataFrame:
    found = decontaminate.find(t.documents.select("doc_id", "text"), t.benchmark)
    best = F.array_max(F.transform("found", lambda x: F.struct(x["share"].alias("share"), (-x["item_id"]).alias("at"))))
    return found.select(
        "row.doc_id", (F.size("found") > 0).alias("contaminated"), F.transform("found", lambda x: x["item_id"]).alias("item_ids"),
        (-best["at"]).alias("item_id"), best["share"].alias("share"),
    )


@query()
def op12_periodic_runs(t: Tables) -> DataFrame:
    """Runs of all documents, with periods planted in one of ten."""
    docs = t.documents.select("doc_id", "text")
    found = periodic.find_runs(docs.withColumn("text", periodic.with_planted_runs(F.col("text"), F.col("doc_id"))))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "strongest.start", "strongest.length", "strongest.period",
        F.expr("strongest.length * 1000 div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query()
def op13_collocations(t: Tables) -> DataFrame:
    """The first 2000 phrases of every language."""
    found = collocations.strongest(collocations.mine(t.documents), 2000)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query()
def op11_html_extraction(t: Tables) -> DataFrame:
    """The main text of all pages."""
    found = html_text.extract(t.pages)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
