"""Substring dedup by level-wise doubling: words covered by a window that occurs anywhere else are removed.

A window is a number of consecutive words, 35 by default; its words are compared as written. Every window is
first judged by a short one inside it, chosen by content: the short window of least hash. Short windows that
occur once rule out the windows they stand for; those that repeat are extended to twice their length and
judged again, until the full length is reached or no candidate survives. Neighbouring windows share their
short ones, so the first level counts about one short window in fourteen words instead of all windows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowloom.session import materialize, scratch_folder

WINDOW = 35
# The first level is not shorter than this, so that it tells texts apart.
SHORTEST = 8
# Odd multipliers of the running sums: two over words, one over bytes.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x2545F4914F6CDD1D)
_IN_WORD = np.array([b not in b" \t\n\v\f\r" for b in range(256)], np.int8)
_CODEC = "zstd"


def levels(window: int) -> list[int]:
    """Window lengths from short to full, each at most twice the one before: 9, 18, 35."""
    lengths = [window]
    while (lengths[0] + 1) // 2 >= SHORTEST:
        lengths.insert(0, (lengths[0] + 1) // 2)
    return lengths


class _Powers:
    """Powers of a base and of its inverse modulo 2^64, as far as the longest text so far."""

    def __init__(self, base: int):
        self.base = (base, pow(base, -1, 1 << 64))
        self.held = [np.ones(1, np.uint64)] * 2

    def upto(self, n: int) -> list[np.ndarray]:
        if len(self.held[0]) < n:
            size = 1 << (n - 1).bit_length()
            self.held = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)])) for b in self.base]
        return self.held


_POWERS = [_Powers(b) for b in _BASES]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_codes(text: bytes) -> np.ndarray:
    """One hash per word of a UTF-8 text, from running sums over its bytes."""
    octets = np.frombuffer(text, np.uint8)
    inside = np.zeros(len(octets) + 2, np.int8)
    inside[1:-1] = _IN_WORD[octets]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    up, down = _POWERS[2].upto(len(octets) + 1)
    sums = np.zeros(len(octets) + 1, np.uint64)
    np.cumsum(octets * up[: len(octets)], out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Windows:
    """Hashes of all windows of one text, of any length, from running sums over its words."""

    def __init__(self, text: bytes):
        codes = word_codes(text)
        self.n = len(codes)
        self.sums = []
        for powers in _POWERS[:2]:
            up, _ = powers.upto(self.n + 1)
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(codes * up[: self.n], out=sums[1:])
            self.sums.append(sums)
            codes = _mixed(codes)

    def hashes(self, at: np.ndarray, length: int, which: int = 0) -> np.ndarray:
        """The hash of the window of ``length`` words at every place in ``at``."""
        _, down = _POWERS[which].upto(self.n + 1)
        return _mixed((self.sums[which][at + length] - self.sums[which][at]) * down[at])

    def least(self, length: int, window: int) -> np.ndarray:
        """For every window the place of its first short window of least hash."""
        codes = self.hashes(np.arange(self.n - length + 1), length)
        span, have = window - length + 1, 1
        best = np.arange(len(codes))
        while have < span:
            step = min(have, span - have)
            left, right = best[:-step], best[step:]
            best = np.where(codes[left] <= codes[right], left, right)
            have += step
        return best


def _candidates(text: bytes, window: int, lone: list[np.ndarray]) -> tuple[Windows, np.ndarray, np.ndarray, int]:
    """The windows that the judged levels leave, and where the next level's window of each begins.

    ``lone[k]`` has the places of level ``k`` whose window occurs once. Returns also the next level's length,
    or ``window`` when all levels are judged.
    """
    lengths = levels(window)
    all_ = Windows(text)
    if all_.n < window:
        return all_, np.zeros(0, np.int64), np.zeros(0, np.int64), window
    starts, place = np.arange(all_.n - window + 1), all_.least(lengths[0], window)
    for k, length in enumerate(lengths):
        if k:
            # The longer window begins where the shorter does, or as late as the full window allows.
            place = np.minimum(place, starts + window - length)
        if k == len(lone):
            return all_, starts, place, length
        alive = ~np.isin(place, lone[k])
        starts, place = starts[alive], place[alive]
    return all_, starts, place, window


def _places(column: list[list[int] | None]) -> list[np.ndarray]:
    return [np.array(x or [], np.int64) for x in column]


def _text(blob: bytes, size: int) -> bytes:
    return pa.Codec(_CODEC).decompress(blob, size, asbytes=True) if size else b""


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec(_CODEC)
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        blobs = [codec.compress(t, asbytes=True) if t else b"" for t in texts]
        sizes = [len(t or b"") for t in texts]
        keys = [xxhash.xxh128_digest(t or b"") for t in texts]
        yield pa.record_batch(
            [batch.column("row_id"), pa.array(blobs, pa.binary()), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary())],
            ["row_id", "blob", "size", "key"],
        )


def _counted(window: int, depth: int):
    """Every window of the level after ``depth`` judged ones, as ``(h, check, row_id, place)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lone = [_places(batch.column(f"lone{k}").to_pylist()) for k in range(depth)]
            rows = zip(batch.column("row_id").to_pylist(), batch.column("blob").to_pylist(), batch.column("size").to_pylist(), batch.column("first").to_pylist())
            for i, (row_id, blob, size, first) in enumerate(rows):
                if first is False:
                    continue
                found, _, place, length = _candidates(_text(blob, size), window, [x[i] for x in lone])
                at = np.unique(place)
                if len(at):
                    check = (found.hashes(at, length, 1) >> np.uint64(33)).astype(np.int32)
                    yield pa.record_batch(
                        [pa.array(found.hashes(at, length).view(np.int64)), pa.array(check), pa.array(np.full(len(at), row_id)), pa.array(at.astype(np.int32))],
                        ["h", "check", "row_id", "place"],
                    )

    return run


def _judged(window: int, depth: int):
    """What remains of every text: number of words, spans of words removed, the kept words."""
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lone = [_places(batch.column(f"lone{k}").to_pylist()) for k in range(depth)]
            totals, removed, cuts, texts = [], [], [], []
            rows = zip(batch.column("blob").to_pylist(), batch.column("size").to_pylist(), batch.column("first").to_pylist())
            for i, (blob, size, first) in enumerate(rows):
                text = _text(blob, size)
                words = text.split()
                n = len(words)
                covered = np.zeros(n + 1, np.int64)
                if n >= window:
                    starts = np.arange(n - window + 1) if first is not None else _candidates(text, window, [x[i] for x in lone])[1]
                    np.add.at(covered, starts, 1)
                    np.add.at(covered, starts + window, -1)
                gone = np.cumsum(covered)[:n] > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                totals.append(n)
                removed.append(int(gone.sum()))
                cuts.append([{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
                texts.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g]))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(cuts, spans), pa.array(texts, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "spans", "kept"],
            )

    return run


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    """Store rows by ``row_id`` in buckets, so that later joins on it move only the other side.

    The table's files lie below ``spark.checkpoint.dir``; its name is in the session's catalog.
    """
    spark, name = rows.sparkSession, f"substring_rows_{uuid.uuid4().hex}"
    writer = rows.repartition(buckets, "row_id").write.option("path", scratch_folder(spark, "substring-rows"))
    writer.bucketBy(buckets, "row_id").sortBy("row_id").saveAsTable(name)
    return spark.table(name)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_removed, spans, kept)`` for every row of ``docs`` (needs ``doc_id``, ``text``).

    ``spans`` lists the runs of words removed, as ``start`` and ``end`` counted in words; ``kept`` has the other
    words joined by one blank. Windows are judged on the input. A null text has no words; a text shorter
    than the window stays whole; rows with equal texts repeat each other; an empty table gives no rows.

    Texts are shuffled once, compressed, into buckets by row. A level is one pass over the buckets and one
    count by window hash, which is summed in every task before it is shuffled, so a passage in very many
    texts is no heavier than another. Windows counted once carry their place along, so what has to be known
    for the next level comes out of the count and needs no join; per text it is a list of places.
    Copies of a text are counted once: all their words repeat if they make a window at all.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col("doc_id"), F.col("text").cast("string").alias("text")
    )
    ids = rows.schema["doc_id"].dataType.simpleString()

    def with_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (made,) = _stored(iter([batch]))
            yield pa.record_batch([*made.columns, batch.column("doc_id")], [*made.schema.names, "doc_id"])

    packed = rows.mapInArrow(with_ids, f"row_id long, blob binary, size long, key binary, doc_id {ids}")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = _bucketed(packed, buckets)
    copies = stored.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("least")).where("n > 1")
    first = stored.select("row_id", "key").join(copies, "key").select("row_id", (F.col("row_id") == F.col("least")).alias("first"))
    # Known of a row: null if its text is the only one, else whether it stands for its copies.
    known = [materialize(first, "substring-copies")]

    def frame(columns: list[str]) -> DataFrame:
        out = stored
        for side in known:
            out = out.join(side.hint("shuffle_hash"), "row_id", "left")
        return out.select(*columns, *[f"lone{k}" for k in range(len(known) - 1)])

    for depth in range(len(levels(window))):
        units = frame(["row_id", "blob", "size", "first"]).mapInArrow(_counted(window, depth), "h long, check int, row_id long, place int")
        met = units.groupBy("h", "check").agg(
            F.count(F.lit(1)).alias("n"), F.min("row_id").alias("row_id"), F.min("place").alias("place")
        )
        # Windows that repeat meet under a null row without places, which tells whether there are any.
        once = F.col("n") == 1
        alone = met.select(F.when(once, F.col("row_id")).alias("row_id"), F.when(once, F.col("place")).alias("place"))
        side = materialize(alone.groupBy("row_id").agg(F.collect_list("place").alias(f"lone{depth}")), "substring-lone")
        known.append(side.where("row_id is not null"))
        if side.where("row_id is null").isEmpty():
            break
    depth = len(known) - 1
    return frame(["doc_id", "blob", "size", "first"]).mapInArrow(
        _judged(window, depth),
        f"doc_id {ids}, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept string",
    )
