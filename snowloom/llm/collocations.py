"""Phrase collocations from a weighted de Bruijn graph of word sequences.

Texts are cut into pieces at punctuation and line ends, pieces into words. Every word begins one edge: it and the
words after it, four in all, up to the end of its piece, where end marks take the missing places. An edge leads
from the node of its first three words to that of its last three. Only edges are counted in the texts. The count of
a node, a phrase of three words, is the sum of the edges that leave it: those to other nodes are its flow, those to
an end mark correct it for the places where a piece ends. Counts of two words and one follow from longer ones alike.

A node that one edge alone leaves lies on a path without branches: phrase and edge are counted alike, so the
edge is kept as a compacted path that stands for both.

Tasks sum edges over some million words before they send them on, by the node they leave, as a dictionary of words
and places in it. A pair of words, or a single one, meets as one partial sum per sender, however frequent.
Words stand in the dictionaries as they are spelt, so no count rests on a hash but for those of the words within the
two million that a task holds at once, which are told apart by 64 bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snowloom.session import materialize

# Words in the longest phrases, and how often a phrase occurs at least.
LONGEST = 4
LEAST = 30
# A phrase is dropped if a longer one that holds it has this share of its occurrences, in hundredths.
CONTAINED = 80
# Words whose edges a task sums before it sends them on.
HELD_WORDS = 2_000_000
# Bytes of text that are cut into words at once.
CUT_BYTES = 1 << 22
_NO_LANGUAGE = "und"
_CUT = re.compile(rb"[.,;:!?\n\v\f\r]")
_CUT_BYTES = [bytes([b]) for b in b".,;:!?\n\v\f\r"]
_IN_WORD = np.array([b not in b" \t.,;:!?\n\v\f\r" for b in range(256)], np.int8)
_CUTS = np.array([b in b".,;:!?\n\v\f\r" for b in range(256)], np.int32)
_BYTES = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_MIX = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))
_CODEC = "zstd"
_SCHEMA = "kind string, bucket int, blob binary, lang string, words array<string>, n long, unary boolean"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX[1]
    x = (x ^ (x >> np.uint64(29))) * _MIX[0]
    return x ^ (x >> np.uint64(32))


def _key(columns: list[np.ndarray]) -> np.ndarray:
    out = _mixed(columns[0])
    for column in columns[1:]:
        out = _mixed(out * _MIX[0] + column)
    return out


def _portions(texts: list[bytes | None], langs: list[str]) -> Iterator[tuple[list[bytes], list[str]]]:
    """Texts in portions of about ``CUT_BYTES``; longer ones are parted where a piece ends anyway, if anywhere."""
    held, of, size = [], [], 0
    for text, lang in zip(texts, langs):
        text = text or b""
        at = 0
        while at < len(text):
            end = at + CUT_BYTES
            if end < len(text):
                cut = max(text.rfind(c, at, end) for c in _CUT_BYTES)
                end = cut + 1 if cut >= 0 else next((m.end() for m in [_CUT.search(text, end)] if m), len(text))
            part = text[at:end]
            held.append(part)
            of.append(lang)
            size, at = size + len(part), end
            if size >= CUT_BYTES:
                yield held, of
                held, of, size = [], [], 0
    if held:
        yield held, of


class _Words:
    """The words of some texts: bytes of all, begin and end of every word, its text and its piece."""

    def __init__(self, texts: list[bytes]):
        self.octets = b"\n".join(texts).lower()
        octets = np.frombuffer(self.octets, np.uint8)
        inside = np.zeros(len(octets) + 2, np.int8)
        inside[1:-1] = _IN_WORD[octets]
        edges = np.flatnonzero(np.diff(inside))
        self.starts, self.ends = edges[::2], edges[1::2]
        text_starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        self.text = np.searchsorted(text_starts, self.starts, "right") - 1
        cuts = np.cumsum(_CUTS[octets])
        self.piece = cuts[self.starts].astype(np.int64)

    def codes(self, seeds: np.ndarray) -> np.ndarray:
        """A hash of every word and the seed of its text, never 0."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        lengths = self.ends - self.starts
        begins = np.cumsum(lengths) - lengths
        octets = np.frombuffer(self.octets, np.uint8)
        spread = np.arange(int(lengths.sum())) - np.repeat(begins, lengths)
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(lengths.max()), _BASE, np.uint64)]))
        values = _BYTES[octets[np.repeat(self.starts, lengths) + spread]] * powers[spread]
        codes = _mixed(np.add.reduceat(values, begins) + seeds[self.text])
        return np.maximum(codes, np.uint64(1))


def _entry_opening(lang: str) -> bytes:
    """What stands before a word in a dictionary: its language, in one line, and a tab."""
    return lang.replace("\\", "\\\\").replace("\n", "\\n").encode() + b"\t"


def _language(opening: bytes) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], opening.decode())


def _hashed(entries: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, entries), np.uint64, len(entries))


def _packed(columns: list[np.ndarray], counts: np.ndarray, entries: list[bytes]) -> bytes:
    """Rows of places in ``entries`` with their counts, as a dictionary of those used and places in it."""
    used = np.zeros(len(entries), bool)
    for column in columns:
        used[column] = True
    held = np.flatnonzero(used)
    place = np.zeros(len(entries), np.uint32)
    place[held] = np.arange(len(held), dtype=np.uint32)
    kind = np.uint16 if len(held) < 1 << 16 else np.uint32
    size = np.uint16 if counts.max() < 1 << 16 else np.int64
    words = b"\n".join([entries[i] for i in held.tolist()])
    parts = [np.array([len(held), len(counts), len(words), np.dtype(size).itemsize], np.int64).tobytes(), words]
    raw = b"".join([*parts, counts.astype(size).tobytes(), *[place[c].astype(kind).tobytes() for c in columns]])
    return np.int64(len(raw)).tobytes() + pa.Codec(_CODEC).compress(raw, asbytes=True)


def _unpacked(blobs: list[bytes], width: int) -> tuple[list[np.ndarray], np.ndarray, list[bytes]]:
    """The rows of all blobs: ``width`` columns of places in one list of entries, the counts and that list.

    The first entry is the empty one, which stands for the end of a piece.
    """
    columns, counts, places = [[] for _ in range(width)], [], {b"": 0}
    for blob in blobs:
        raw = pa.Codec(_CODEC).decompress(blob[8:], int(np.frombuffer(blob, np.int64, 1)[0]), asbytes=True)
        held, rows, size, width_of_count = np.frombuffer(raw, np.int64, 4).tolist()
        at = 32 + size
        place = np.array([places.setdefault(e, len(places)) for e in raw[32:at].split(b"\n")], np.uint32)
        counts.append(np.frombuffer(raw, np.uint16 if width_of_count == 2 else np.int64, rows, at).astype(np.int64))
        at += width_of_count * rows
        kind = np.dtype(np.uint16 if held < 1 << 16 else np.uint32)
        for column in columns:
            column.append(place[np.frombuffer(raw, kind, rows, at)])
            at += kind.itemsize * rows
    return [np.concatenate(c) for c in columns], np.concatenate(counts), list(places)


def _groups(columns: list[np.ndarray], key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal rows together, and where in it each group begins.

    Rows are sorted by ``key``; if two different ones share it, by their columns instead.
    """
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]]) if len(key) else np.zeros(0, bool)
    for column in columns:
        c = column[order]
        if (c[1:] != c[:-1])[~new[1:]].any():
            order = np.lexsort(columns[::-1])
            new = np.concatenate([[True], np.zeros(len(key) - 1, bool)])
            for other in columns:
                new[1:] |= other[order][1:] != other[order][:-1]
            break
    return order, np.flatnonzero(new)


def _summed(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows and their summed counts."""
    if not len(counts):
        return columns, counts
    order, begins = _groups(columns, _key(columns))
    return [c[order[begins]] for c in columns], np.add.reduceat(counts[order], begins)


def _rows(size: int, **columns) -> pa.RecordBatch:
    """A batch of ``size`` rows of the common schema; what is not given is null."""
    kinds = {"kind": pa.string(), "bucket": pa.int32(), "blob": pa.binary(), "lang": pa.string(), "words": pa.list_(pa.string()), "n": pa.int64(), "unary": pa.bool_()}
    return pa.record_batch([pa.array(columns.get(name, [None] * size), kind) for name, kind in kinds.items()], list(kinds))


def _dealt(kind: str, columns: list[np.ndarray], counts: np.ndarray, entries: list[bytes], hashes: np.ndarray, node: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of places in ``entries``, one blob for each bucket of their first ``node`` words.

    They are in order of their words, which compresses best.
    """
    alphabetical = sorted(range(len(entries)), key=entries.__getitem__)
    rank = np.empty(len(entries), np.uint32)
    rank[alphabetical] = np.arange(len(entries), dtype=np.uint32)
    bucket = (_key([hashes[c] for c in columns[:node]]) % np.uint64(buckets)).astype(np.int64)
    columns, entries = [rank[c] for c in columns], [entries[i] for i in alphabetical]
    order = np.argsort(bucket * len(entries) + columns[0])
    which, begins = np.unique(bucket[order], return_index=True)
    for b, at in zip(which.tolist(), np.split(order, begins[1:])):
        yield _rows(1, kind=[kind], bucket=[b], blob=[_packed([c[at] for c in columns], counts[at], entries)])


def _counted(longest: int, held_words: int, buckets: int):
    """Edges of the texts, summed over ``held_words`` words."""

    def sent(held: list[tuple[np.ndarray, np.ndarray, _Words, list[bytes]]]) -> Iterator[pa.RecordBatch]:
        """The edges of some portions: codes and pieces of their words, the words, what stands before each text's."""
        names, first, place = np.unique(np.concatenate([h[0] for h in held]), return_index=True, return_inverse=True)
        n, piece = len(place), np.concatenate([*[h[1] for h in held], np.full(longest, -1)])
        # Every word is spelt as where it was met first.
        entries: list[bytes] = [b""] * (len(names) + 1)
        begin = 0
        for codes, _, words, opening in held:
            which = np.flatnonzero((first >= begin) & (first < begin + len(codes)))
            at = first[which] - begin
            for i, t, a, z in zip((which + 1).tolist(), words.text[at].tolist(), words.starts[at].tolist(), words.ends[at].tolist()):
                entries[i] = opening[t] + words.octets[a:z]
            begin += len(codes)
        names = np.concatenate([[np.uint64(0)], names])
        place = np.concatenate([place.astype(np.uint32) + np.uint32(1), np.zeros(longest, np.uint32)])
        columns = [np.where(piece[k : n + k] == piece[:n], place[k : n + k], np.uint32(0)) for k in range(longest)]
        order, begins = _groups(columns, _key([names[c] for c in columns]))
        counts = np.diff(np.concatenate([begins, [n]]))
        columns = [c[order[begins]] for c in columns]
        yield from _dealt("edges", columns, counts, entries, _hashed(entries), longest - 1, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, 0
        for batch in batches:
            texts, languages = batch.column("text").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist()
            for portion, langs in _portions(texts, languages):
                words = _Words(portion)
                codes = words.codes(np.array([xxhash.xxh64_intdigest(x.encode(), 3) for x in langs], np.uint64))
                if not len(codes):
                    continue
                pieces = words.piece + last
                held.append((codes, pieces, words, [_entry_opening(x) for x in langs]))
                size, last = size + len(codes), int(pieces[-1]) + 1
                if size >= held_words:
                    yield from sent(held)
                    held, size = [], 0
        if held:
            yield from sent(held)

    return run


def _phrases(kind: str, columns: list[np.ndarray], counts: np.ndarray, entries: list[bytes], unary: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    if len(counts):
        parts = [[entries[i].rpartition(b"\t") for i in c.tolist()] for c in columns]
        yield _rows(
            len(counts), kind=[kind] * len(counts), bucket=(np.arange(len(counts)) % 1024).tolist(), lang=[_language(p[0]) for p in parts[0]],
            words=[[p[2].decode() for p in row] for row in zip(*parts)], n=counts.tolist(), unary=(np.zeros(len(counts), bool) if unary is None else unary).tolist(),
        )


def _sorted_out(batches: Iterator[pa.RecordBatch], taken: str, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Collect the blobs of one kind and let the phrases through."""
    for batch in batches:
        kinds = batch.column("kind").to_pylist()
        blobs += [b for k, b in zip(kinds, batch.column("blob").to_pylist()) if k == taken]
        yield batch.filter(pa.array([k == "phrase" for k in kinds]))


def _level(width: int, longest: int, least: int, buckets: int):
    """Sum the counts of phrases of ``width`` words in one partition, and pass on the next shorter ones' partial sums.

    The longest phrases also settle the nodes they leave.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: list[bytes] = []
        yield from _sorted_out(batches, "edges" if width == longest else f"sums{width}", blobs)
        if not blobs:
            return
        columns, counts, entries = _unpacked(blobs, width)
        blobs.clear()
        columns, counts = _summed(columns, counts)
        at = np.flatnonzero((counts >= least) & (columns[-1] > 0))
        if width < longest:
            yield from _phrases("phrase", [c[at] for c in columns], counts[at], entries)
        else:
            edges, flows = columns, counts
            order, begins = _groups(edges[:-1], _key(edges[:-1]))
            ordered = flows[order]
            columns, counts = [c[order[begins]] for c in edges[:-1]], np.add.reduceat(ordered, begins)
            # Where one edge, to another node, takes all of its node's flow, the edge stands for the node too.
            path = (np.maximum.reduceat(ordered, begins) == counts) & (edges[-1][order[begins]] > 0)
            unary = np.zeros(len(flows), bool)
            unary[order] = np.repeat(path, np.diff(np.concatenate([begins, [len(order)]])))
            yield from _phrases("phrase", [c[at] for c in edges], flows[at], entries, unary[at])
            at = np.flatnonzero((counts >= least) & (columns[-1] > 0) & ~path)
            yield from _phrases("phrase", [c[at] for c in columns], counts[at], entries)
        shorter, sums = _summed(columns[:-1], counts)
        # Entries that no shorter phrase holds are left behind.
        used, places = np.unique(np.concatenate(shorter), return_inverse=True)
        entries = [entries[i] for i in used.tolist()]
        yield from _dealt(f"sums{len(shorter)}", np.split(places, len(shorter)), sums, entries, _hashed(entries), len(shorter), buckets)

    return run


def _single(least: int):
    """Words with their counts, as often as phrases at least, and the number of all words by language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: list[bytes] = []
        yield from _sorted_out(batches, "sums1", blobs)
        if not blobs:
            return
        columns, counts, entries = _unpacked(blobs, 1)
        (column,), counts = _summed(columns, counts)
        at = np.flatnonzero(counts >= least)
        yield from _phrases("word", [column[at]], counts[at], entries)
        totals: dict[bytes, int] = {}
        for i, n in zip(column.tolist(), counts.tolist()):
            opening = entries[i].rpartition(b"\t")[0]
            totals[opening] = totals.get(opening, 0) + n
        yield _rows(len(totals), kind=["total"] * len(totals), n=list(totals.values()), lang=[_language(x) for x in totals])

    return run


def count_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """Counts of all phrases of up to ``longest`` words that occur ``least`` times, written to the shared folder.

    Rows have a ``kind``: ``phrase`` (``lang``, two ``words`` or more, ``n``, and ``unary`` where the phrase without its last word
    is counted alike and has no row), ``word`` (``lang``, one of ``words``, ``n``) and ``total`` (``lang``, ``n`` words; may be several
    rows a language).
    """
    if longest < 3:
        raise ValueError("phrases of three words at least make a graph")
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(_NO_LANGUAGE)).alias("lang")
    ).mapInArrow(_counted(longest, HELD_WORDS, partitions), _SCHEMA)
    for width in [longest, *range(longest - 2, 1, -1)]:
        rows = rows.repartitionById(partitions, F.col("bucket")).mapInArrow(_level(width, longest, least, partitions), _SCHEMA)
    rows = rows.repartitionById(partitions, F.col("bucket")).mapInArrow(_single(least), _SCHEMA)
    return materialize(rows.select("kind", "lang", "words", "n", "unary"), "collocation-counts")


def _parts(words: Column, shortest: int) -> Column:
    """All phrases of ``shortest`` words or more inside a phrase, itself left out."""
    sizes = F.sequence(F.lit(shortest), F.size(words) - 1)
    return F.flatten(F.transform(sizes, lambda k: F.transform(F.sequence(F.lit(1), F.size(words) - k + 1), lambda i: F.slice(words, i, k))))


def mine(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, contained: int = CONTAINED) -> DataFrame:
    """``(lang, phrase, a, l, r, n, score)`` for every phrase of ``docs`` (needs ``text``, ``lang``) worth keeping.

    A candidate has 2 to ``longest`` words and occurs ``a >= least`` times within pieces of its language's texts. ``l`` and
    ``r`` count the parts of its weakest cut, ``score`` is ``floor(2000000 * a / (l + r))`` there (ties: the first cut), ``n`` the
    language's words. Candidates inside a longer one with ``100 * f(longer) >= contained * a`` are left out.
    Texts are lower-cased (A-Z); a null text is empty, a null language ``und``; rows with equal texts count each;
    other columns are left out, whatever their names; an empty table gives no rows.
    """
    if contained > 100:
        raise ValueError("contained is at most 100")
    counts = count_phrases(docs, longest, least)
    totals = counts.where("kind = 'total'").groupBy("lang").agg(F.sum("n").alias("n"))
    phrases = counts.where("kind = 'phrase'")
    nodes = phrases.where("unary").select("lang", F.slice("words", 1, F.size("words") - 1).alias("words"), "n")
    known = counts.where("kind in ('phrase', 'word')").select("lang", "words", "n").unionByName(nodes)
    candidates = phrases.select("lang", "words", F.col("n").alias("a"))

    # A node that its edge stands for is inside that edge, so it is no candidate that could stay.
    held = candidates.where(F.size("words") > 2).select("lang", "a", F.explode(_parts(F.col("words"), 2)).alias("words"))
    over = held.groupBy("lang", "words").agg(F.max("a").alias("longer"))
    kept = candidates.join(over, ["lang", "words"], "left").where(F.expr(f"longer is null or 100 * longer < {int(contained)} * a")).drop("longer")

    cuts = kept.select("lang", "words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.slice("words", 1, F.col("k"))).withColumn("right", F.expr("slice(words, k + 1, size(words) - k)"))
    cuts = cuts.join(known.select("lang", F.col("words").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(known.select("lang", F.col("words").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    score = F.expr("(cast(a as decimal(19, 0)) * 2000000) div (cast(l as decimal(19, 0)) + r)")
    weakest = cuts.groupBy("lang", "words", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return weakest.join(totals, "lang").select("lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")


def strongest(found: DataFrame, most: int) -> DataFrame:
    """The first ``most`` phrases of each language with their ``rank``: by score and count descending, then phrase by bytes.

    Rows of a language are first cut to ``most`` in each of 64 groups, so one task gets 64 times that at most.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = found.withColumn("part", part)
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= most)
    ranked = first.drop("part", "rank").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= most).withColumn("rank", F.col("rank").cast("long"))
