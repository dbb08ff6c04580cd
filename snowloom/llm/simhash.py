"""SimHash near-duplicates: deletion-variant signatures of two segments, equality join, verification.

Texts: ASCII letters are lower-cased, words are runs of anything but ASCII white space, shingles are three
words joined by a blank, repeats included. A text of one or two words is one shingle; a text without words,
an empty and a null text have fingerprint zero, which links like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snowloom.llm.components import components
from snowloom.session import materialize

SEED = 42
SHINGLE = 3
# Shingles voting at once: 64 bytes each.
_CHUNK = 1 << 16
# More fingerprints than this on one key are linked through shared neighbours instead of pair by pair.
PAIRED = 64


def fingerprint(text: bytes) -> int:
    """The 64-bit fingerprint of a UTF-8 text: a bit is set if more than half the shingle hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles, n = [b" ".join(words)], 1
    else:
        shingles, n = map(b" ".join, zip(words, words[1:], words[2:])), len(words) - SHINGLE + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    votes = np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        octets = hashes[i : i + _CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        prints = np.array([fingerprint(t or b"") for t in texts], np.uint64).view(np.int64)
        yield pa.record_batch([batch.column("doc_id"), batch.column("tie"), pa.array(prints)], ["doc_id", "tie", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, tie, fp)`` for every row of ``docs``; ``fp`` holds the 64 bits as a signed long, ``tie`` a hash
    of the text that tells rows of one id apart."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("tie"), text.alias("text")).mapInArrow(
        _fingerprints, "doc_id long, tie long, fp long"
    )


def _keys() -> list[Column]:
    """The index keys of one fingerprint, as longs: a tag in the upper bits, kept bits below.

    Cut into two segments of 32 bits, two fingerprints that differ in at most two bits have a segment that
    differs in at most one, so they share one of its 32 one-wildcard variants. A variant alone would put
    the fingerprints of a group of near copies on few keys; each therefore also carries a piece of the
    other segment that must then be equal: with one bit or none there, one of its two halves; with two
    bits there, the segment is whole and one of three thirds of the other is equal.
    """
    high, low = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    keys, tag = [], 0

    def key(kept: Column) -> None:
        nonlocal tag
        keys.append(F.shiftleft(F.lit(tag).cast("long"), 48).bitwiseOR(kept))
        tag += 1

    halves = [F.shiftrightunsigned(low, 16), low.bitwiseAND(F.lit(0xFFFF))]
    for bit in range(32):
        variant = high.bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << bit)))
        for half in halves:
            key(F.shiftleft(variant, 16).bitwiseOR(half))
    for whole, other in ((high, low), (low, high)):
        for shift in (0, 11, 22):
            third = F.shiftrightunsigned(other, shift).bitwiseAND(F.lit(0x7FF))
            key(F.shiftleft(whole, 11).bitwiseOR(third))
    return keys


def links(prints: DataFrame, paired: int = PAIRED) -> DataFrame:
    """``(a, b)``: links between distinct values of ``fp`` that differ in at most two bits.

    All pairs on a key are verified while the key has at most ``paired`` fingerprints, so pairs grow with
    the keys and not with their square. Fingerprints of fuller keys take another exact way: two that differ
    in at most two bits are both at most one bit from some third value, so all sharing such a value are
    linked to the smallest of them, which connects the same fingerprints.
    """
    keyed = prints.select("fp", F.explode(F.array(*_keys())).alias("key"))
    counted = keyed.withColumn("n", F.count(F.lit(1)).over(W.partitionBy("key")))
    shared = materialize(counted.where("n > 1"), "simhash-keys")
    few = shared.where(F.col("n") <= paired)
    left = few.select("key", F.col("fp").alias("a"))
    right = few.select("key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2
    pairs = left.join(right, "key").where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()
    full = shared.where(F.col("n") > paired).select("fp").distinct()
    around = [F.col("fp"), *[F.col("fp").bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), i)) for i in range(64)]]
    spots = full.select("fp", F.explode(F.array(*around)).alias("key"))
    # At most 65 fingerprints are within one bit of a value.
    stars = spots.withColumn("least", F.min("fp").over(W.partitionBy("key")))
    return pairs.unionByName(stars.select(F.col("least").alias("a"), F.col("fp").alias("b")).where("a <> b").distinct())


def _grouped(docs: DataFrame) -> DataFrame:
    """The fingerprinted rows with the ``root`` of their group and its ``component_id``."""
    marked = materialize(fingerprints(docs), "simhash")
    prints = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-prints")
    roots = components(links(prints))
    rooted = prints.join(roots, prints.fp == roots.node, "left").select(
        prints.fp, "first", F.coalesce("root", prints.fp).alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked.join(rooted.join(ids, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs`` (needs ``doc_id`` and ``text``).

    ``component_id`` is the smallest ``doc_id`` reachable over links of at most two differing bits. Equal
    fingerprints are reduced to one before linking, so copies cost nothing there. Rows with a null
    ``doc_id`` stay and take part, but give no component its id; a component of such rows alone has null.
    Repeated rows stay repeated. An empty table gives no rows.
    """
    return _grouped(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per group, the one with the smallest ``doc_id``, with its columns unchanged.

    Of several rows with that id the text of the least hash stays, and of equal texts the row of the least
    hash, so reruns agree. A group of null ids alone keeps one row too.
    """
    firsts = _grouped(docs).where("doc_id <=> component_id").groupBy("root").agg(
        F.min("component_id").alias("__id"), F.min("tie").alias("__tie")
    )
    tie = F.xxhash64(F.col("text").cast("string"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (tie == F.col("__tie"))
    kept = docs.join(firsts.select("__id", "__tie"), same, "left_semi")
    one = W.partitionBy("doc_id", tie).orderBy(F.xxhash64(*docs.columns))
    return kept.withColumn("__row", F.row_number().over(one)).where("__row = 1").drop("__row")
