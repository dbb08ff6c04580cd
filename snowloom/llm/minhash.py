"""Document fingerprints: one-permutation MinHash with optimal densification, packed low-order bits.

Native: Spark's own functions only. A text's words are runs of anything but ASCII white space, as written;
shingles are five words, a shorter text is one shingle, a text without words is one shingle of its own kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snowloom.llm.native import let, words
from snowloom.session import materialize

SHINGLE = 5
# The upper seven bits of a hash choose one of 128 bins, the lower four bits of a bin's least hash are kept.
BIN_BITS, KEPT_BITS = 7, 4
BINS = 1 << BIN_BITS
_PER_LONG = 64 // KEPT_BITS
# Neighbouring ids that are ordered together.
_RUN = 1024


def _shingle_hashes(text: Column) -> Column:
    """One 64-bit hash per shingle, from the hashes of its words."""

    def hashes(w: Column) -> Column:
        n = F.size(w)
        runs = F.transform(
            F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE)])
        )
        return F.when(n < SHINGLE, F.array(F.xxhash64(n, w))).otherwise(runs)

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), hashes)


def _bin(hash_: Column) -> Column:
    return F.shiftright(hash_, 64 - BIN_BITS).cast("int")


def _densified(least: Column) -> Column:
    """The kept bits of all bins, from the least hash of every bin that has one, in order of bins.

    Optimal densification: an empty bin goes through all bins in a random order of its own, the same for
    every document, and takes the first that has a hash: the one of lowest rank under a hash of both bins.
    """
    kept = F.lit((1 << KEPT_BITS) - 1)

    def filled(bins: Column) -> Column:
        def own_or_borrowed(b: Column) -> Column:
            place = F.array_position(bins, b).cast("int")
            rank = F.transform(bins, lambda x, i: F.xxhash64(b, x).bitwiseAND(F.lit(-BINS)).bitwiseOR(i.cast("long")))
            lender = F.array_min(rank).bitwiseAND(F.lit(BINS - 1)).cast("int")
            return F.get(least, F.when(place > 0, place - 1).otherwise(lender)).bitwiseAND(kept)

        return F.transform(F.sequence(F.lit(-BINS // 2), F.lit(BINS // 2 - 1)), own_or_borrowed)

    full = F.transform(least, lambda x: x.bitwiseAND(kept))
    return F.when(F.size(least) == BINS, full).otherwise(let(F.transform(least, _bin), filled))


def _packed(digits: Column) -> Column:
    def long(k: Column) -> Column:
        part = F.slice(digits, k * _PER_LONG + 1, F.lit(_PER_LONG))
        return F.aggregate(part, F.lit(0).cast("long"), lambda a, d: F.shiftleft(a, KEPT_BITS).bitwiseOR(d))

    return F.transform(F.sequence(F.lit(0), F.lit(BINS // _PER_LONG - 1)), long)


def signature(text: Column) -> Column:
    """The packed fingerprint of a text, as an array of longs; a null text counts as empty.

    Shingles are hashed once. Sorted, the first hash of every bin is its least.
    """

    def firsts(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1))))

    hashes = F.sort_array(_shingle_hashes(F.coalesce(text, F.lit(""))))
    return let(let(let(hashes, firsts), _densified), _packed)


def as_text(packed: Column) -> Column:
    return F.array_join(F.transform(packed, lambda p: F.lpad(F.lower(F.hex(p)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """The estimated Jaccard similarity of two packed fingerprints, from 0 to 1.

    Bins agree by chance with probability 2^-b for b kept bits, which is taken out of the share that agrees.
    """
    lowest = F.lit(int("1" * _PER_LONG, 16))

    def differing(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        for shift in (2, 1):
            d = d.bitwiseOR(F.shiftrightunsigned(d, shift))
        return F.bit_count(d.bitwiseAND(lowest))

    unequal = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda s, x: s + x.cast("int"))
    chance = 1 / (1 << KEPT_BITS)
    return F.greatest(F.lit(0.0), ((F.lit(1.0) - unequal / F.lit(float(BINS))) - chance) / (1 - chance))


def with_next(rows: DataFrame, order: list[str], payload: str) -> DataFrame:
    """Add ``next``: ``payload`` of the following row by ``order``, after the last that of the first.

    The first name in ``order`` is a whole number. Rows meet in runs of neighbouring numbers, and the last
    row of a run takes the first row of the next run there is. Only one number per run is ordered in one task.
    """
    run = F.coalesce(F.floor(F.col(order[0]) / _RUN), F.lit(-(1 << 62))).cast("long")
    runs = rows.withColumn("__run", run)
    following = F.lead(F.struct(payload)).over(W.partitionBy("__run").orderBy(*order))
    heads = runs.groupBy("__run").agg(F.min_by(F.struct(payload), F.struct(*order)).alias("__head"))
    names = heads.select("__run")
    first = F.min("__run").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    chain = names.select(F.col("__run").alias("__of"), F.coalesce(F.lead("__run").over(W.orderBy("__run")), first).alias("__run"))
    after = heads.join(chain, "__run").select(F.col("__of").alias("__run"), "__head")
    joined = runs.withColumn("__next", following).join(after, "__run")
    value = F.coalesce("__next", "__head").getField(payload)
    return joined.select(*rows.columns, value.alias("next"))


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Every document beside its edited text: its last quarter replaced by the start of the next document.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    A null text is an empty one. Documents are ordered by ``doc_id`` (null first), repeated ids by the
    hash of their text; a single document is its own next. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("tie"))
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next", F.lit(1), quarter))
    texts = with_next(rows, ["doc_id", "tie"], "text").select(
        "doc_id", "tie", "text", n.cast("long").alias("n_chars"), edited.alias("edited")
    )
    marked = materialize(
        texts.select(
            "doc_id", "tie", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
            signature(F.col("text")).alias("own"), signature(F.col("edited")).alias("other"),
        ),
        "fingerprints",
    )
    return with_next(marked, ["doc_id", "tie"], "own").select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("other")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )
