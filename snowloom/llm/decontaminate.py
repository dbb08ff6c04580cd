"""Benchmark decontamination by latent semantic retrieval, verified by longest common subsequences.

Texts are lower-cased words without ASCII punctuation. Documents are cut into passages of two blocks of
``BLOCK`` words, each passage beginning one block after the last. The features are the words of the
benchmark, weighted by TF-IDF over all blocks of all documents. A randomised SVD of the passages, of documents
and of the benchmark, gives the latent space; passages near an item in it are candidates, and a candidate
counts if enough of the item's words stand there in order. Cosines fall with the corpus and with words outside
the benchmark, so passages that hold the words without which nothing can count are candidates at any cosine.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowloom.session import materialize

BLOCK = 16
DIMENSIONS, OVERSAMPLED = 144, 8
# Cosine from which on a passage is a candidate whatever words it holds.
CANDIDATE = 0.2
# Share of an item's words that must stand in order: alone, or with the answer.
COPIED, PARAPHRASED = 0.8, 0.5
ANSWERED = 0.9
# Share of an item's TF-IDF energy that a paraphrase holds where no passage is near. Below stand common words
# alone, as any text has them; neither the corpus nor the words around a paraphrase change it.
TELLING = 0.15
# Items handled at once: few enough for the axes to tell them apart. Bounds what is sent to every task; more
# items are searched set by set.
ITEMS = 256
# Energy of the benchmark's own passages in the decomposition, in times that of the documents'.
BENCHMARK_SHARE = 20.0
# Words that are counted densely, as they are most of what stands in a text.
FREQUENT = 256
# Words looked at at once when candidates are told by their words.
_LOOKED = 1 << 20
_SPACED = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))
_ANSWER = re.compile(r"(?i)\banswer\s*[:=]|\?")


def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_SPACED).split()


def answer(text: str) -> list[bytes]:
    """The words behind the last question mark or ``answer:``; without one, the last sentence."""
    marks = [m.end() for m in _ANSWER.finditer(text)]
    found = words(text[marks[-1] :]) if marks else []
    if found:
        return found
    sentences = [w for s in re.split(r"[.!?\n]+", text) if (w := words(s))]
    return sentences[-1] if sentences else []


@dataclass
class Item:
    """One item with what its verification needs."""

    item_id: int
    words: list[bytes]
    answer: list[bytes]
    masks: list[dict[bytes, int]] = field(default_factory=list)
    # What each word has of the item's TF-IDF energy.
    energy: dict[bytes, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for pattern in (self.words, self.answer):
            mask: dict[bytes, int] = {}
            for i, w in enumerate(pattern):
                mask[w] = mask.get(w, 0) | 1 << i
            self.masks.append(mask)

    def shares(self, region: list[bytes]) -> tuple[float, float]:
        """The share of the item's and of its answer's words that the region has in order."""
        return tuple(
            common_subsequence(mask, len(pattern), region) / len(pattern) if pattern else 0.0
            for mask, pattern in zip(self.masks, (self.words, self.answer))
        )

    def telling(self, region: list[bytes]) -> float:
        """The share of the item's TF-IDF energy that stands in the region."""
        return sum(self.energy[w] for w in self.energy.keys() & set(region))


def common_subsequence(masks: dict[bytes, int], n: int, region: list[bytes]) -> int:
    """Length of the longest common subsequence with a pattern of ``n`` words, a machine word of the pattern at once."""
    full = (1 << n) - 1
    rows = full
    for m in filter(None, map(masks.get, region)):
        u = rows & m
        rows = ((rows + u) | (rows - u)) & full
    return n - rows.bit_count()


def numbers(cut: list[list[bytes]], known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """The feature numbers of the words of all texts, -1 where unknown, and the number of words of each text."""
    sizes = np.fromiter(map(len, cut), np.int64, len(cut))
    return np.fromiter(map(known.get, chain.from_iterable(cut), repeat(-1)), np.int64, int(sizes.sum())), sizes


@dataclass
class Blocks:
    """The known words of a batch of texts, as feature numbers with the block each stands in."""

    texts: list[list[bytes]]
    ids: np.ndarray
    block: np.ndarray
    # False where the word stands in the block before. A word counts once in a block; its repeats only add to
    # the length of a passage, so text that repeats a common word is near nothing.
    new: np.ndarray
    unknown: np.ndarray
    first: np.ndarray
    n: int
    parts: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    @classmethod
    def of(cls, texts: list[str | None], known: dict[bytes, int]) -> Blocks:
        cut = [words(t or "") for t in texts]
        return cls.numbered(cut, *numbers(cut, known))

    @classmethod
    def numbered(cls, texts: list[list[bytes]], ids: np.ndarray, sizes: np.ndarray) -> Blocks:
        """From the feature numbers of all words, -1 where unknown, and the number of words of each text."""
        counts = -(-sizes // BLOCK)
        first = np.concatenate([[0], np.cumsum(counts)])
        place = np.arange(len(ids)) - np.repeat(np.concatenate([[0], np.cumsum(sizes)])[:-1], sizes)
        block = np.repeat(first[:-1], sizes) + place // BLOCK
        n = int(first[-1])
        unknown = np.bincount(block[ids < 0], minlength=n)
        ids, block = ids[ids >= 0], block[ids >= 0]
        new, both = np.ones(len(ids), bool), block * (int(ids.max(initial=0)) + 1) + ids
        for back in range(1, BLOCK):
            new[back:] &= both[back:] != both[:-back]
        return cls(texts, ids, block, new, unknown, first, n)

    def split(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the most frequent words stand in each block, and the other words with their blocks.

        Numbers go by frequency, so the first ``FREQUENT`` have most of the words and are multiplied densely.
        """
        if self.parts is None:
            size = min(FREQUENT, size)
            ids, block = self.ids[self.new], self.block[self.new]
            often = ids < size
            held = np.zeros(self.n * size, np.float32)
            held[block[often] * size + ids[often]] = 1
            self.parts = held.reshape(self.n, size), ids[~often], block[~often]
        return self.parts

    def sums(self, rows: np.ndarray) -> np.ndarray:
        """``rows`` of the known words, summed by block."""
        counts, ids, block = self.split(len(rows))
        out = counts @ rows[: counts.shape[1]]
        # The first of these words of every block, then the second: no block has more than its words.
        begins = np.concatenate([[True], block[1:] != block[:-1]])[: len(ids)]
        place = np.arange(len(ids)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]
        order = np.argsort(place.astype(np.int8), kind="stable")
        for part in np.split(order, np.cumsum(np.bincount(place))[:-1]) if len(ids) else ():
            out[block[part]] += rows.take(ids[part], axis=0)
        return out

    def whole(self) -> np.ndarray:
        """The passages that are not the end of the one before: all but a longer text's last block alone."""
        used = np.ones(self.n, bool)
        used[self.first[1:][np.diff(self.first) > 1] - 1] = False
        return used

    def paired(self, by_block: np.ndarray) -> np.ndarray:
        """Blocks summed to passages: each with the next block of its text, the last one alone."""
        following = by_block[1:].copy()
        last = self.first[1:][np.diff(self.first) > 0] - 1
        following[last[last < len(following)]] = 0
        out = by_block.copy()
        out[:-1] += following
        return out


# As words are kept between the passes: the vocabulary of a set of items may not fit two bytes.
_KEPT = np.dtype("<i4")


def _numbered(known):
    """The texts as the feature numbers of their words, so that they are cut into words once for both passes of the fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes = numbers([words(t or "") for t in batch.column("text").to_pylist()], known.value)
            held, ends = ids.astype(_KEPT), np.cumsum(sizes)
            kept = [held[e - n : e].tobytes() for e, n in zip(ends.tolist(), sizes.tolist())]
            yield pa.record_batch([pa.array(kept, pa.binary())], ["ids"])

    return run


def _blocks(batch: pa.RecordBatch, places: np.ndarray | None = None) -> Blocks:
    """The blocks of kept texts, with features numbered anew by ``places`` if asked."""
    kept = batch.column("ids").to_pylist()
    ids = np.frombuffer(b"".join(kept), _KEPT).astype(np.int64)
    if places is not None:
        ids = np.append(places, -1)[ids]
    return Blocks.numbered([], ids, np.fromiter(map(len, kept), np.int64, len(kept)) // _KEPT.itemsize)


def _document_counts(size: int):
    """Blocks per word, and under ``-1`` the number of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(size, np.int64), 0
        for batch in batches:
            b = _blocks(batch)
            held += np.bincount(b.ids[b.new], minlength=size)
            n += b.n
        at = np.flatnonzero(held)
        yield pa.record_batch([pa.array(np.append(at, -1)), pa.array(np.append(held[at], n))], ["f", "n"])

    return run


def _gram_times(b: Blocks, idf: np.ndarray, basis: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """``A'A`` times the basis for the TF-IDF passages ``A`` of a batch, weighted if asked, and the energy of ``A``."""
    scaled = (idf[:, None] * basis).astype(np.float32)
    image = b.paired(b.sums(scaled))
    if weights is not None:
        image *= weights[:, None].astype(np.float32)
    # A word's row of A' meets both passages its block is part of.
    back = image[:-1].copy()
    begins = b.first[:-1][np.diff(b.first) > 0]
    back[begins[begins > 0] - 1] = 0
    image[1:] += back
    counts, ids, block = b.split(len(basis))
    out = np.zeros(basis.shape, np.float64)
    out[: counts.shape[1]] = counts.T @ image
    order = np.argsort(ids, kind="stable")
    if len(order):
        ids = ids[order]
        starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        out[ids[starts]] = np.add.reduceat(image.take(block[order], axis=0), starts, axis=0)
    return out * idf[:, None], 2.0 * float((idf[b.ids[b.new]] ** 2).sum())


def _sketch(space):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, idf, basis = space.value
        held, energy = np.zeros(basis.shape), 0.0
        for batch in batches:
            part, more = _gram_times(_blocks(batch, places), idf, basis)
            held += part
            energy += more
        at = np.flatnonzero(np.abs(held).sum(axis=1))
        held = np.vstack([held[at], np.full((1, basis.shape[1]), energy)])
        columns = [pa.array(np.append(at, -1)), *(pa.array(held[:, j]) for j in range(held.shape[1]))]
        yield pa.record_batch(columns, ["f", *(f"y{j}" for j in range(held.shape[1]))])

    return run


def _leading(image: np.ndarray, basis: np.ndarray, d: int) -> np.ndarray:
    """Leading eigenvectors of a positive matrix from its product with a random basis (Nystroem's method)."""
    shift = 1e-6 * np.linalg.norm(image) + 1e-12
    image = image + shift * basis
    core = basis.T @ image
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    kept = values > values.max() * 1e-10
    half = image @ (vectors[:, kept] / np.sqrt(values[kept]))
    return np.linalg.svd(half, full_matrices=False)[0][:, :d]


def _least(share: float, n: int) -> int:
    """The fewest of ``n`` words that are the share."""
    return next(m for m in range(n + 1) if m / n >= share)


@dataclass
class Needed:
    """The words without which a passage holds no item: what is found by them is all that can count.

    Of an item of ``n`` words ``m`` can only stand in order where, for every ``k``, ``k`` of its ``n - m + k`` rarest
    ones stand. With ``k = 1`` for a copy, a paraphrase or the answer that gives the anchors, looked up by word;
    with the most telling ``k`` for half of the item the words that must stand around an anchor.
    """

    # Items by anchor: those of word w are items[starts[w]:starts[w + 1]].
    starts: np.ndarray
    items: np.ndarray
    # Blocks that an item's region adds on each side, words that it needs and which ones they are, energy that it
    # needs and what each word has of it.
    reach: np.ndarray
    least: np.ndarray
    rare: np.ndarray
    floor: np.ndarray
    energy: np.ndarray

    @classmethod
    def of(cls, items: list[Item], known: dict[bytes, int], counts: np.ndarray, blocks: float) -> Needed:
        pairs: set[tuple[int, int]] = set()
        reach, least = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
        rare, floor = np.zeros((len(items), len(known)), np.uint8), np.zeros(len(items))
        energy = np.zeros(rare.shape, np.float32)
        for at, item in enumerate(items):

            def rarest(pattern: list[bytes]) -> np.ndarray:
                ids = np.array([known.get(w, -1) for w in pattern])
                return ids[np.argsort(counts[ids], kind="stable")]

            n, by_words, by_answer = len(item.words), rarest(item.words), rarest(item.answer)
            half = _least(PARAPHRASED, n)
            ways = [set(by_words[: n - half + 1].tolist())]
            # Cut out of its text, a word may have been lowered to one that the text does not have.
            if len(by_answer) and by_answer.min() >= 0:
                ways.append(set(by_answer[: len(by_answer) - _least(ANSWERED, len(by_answer)) + 1].tolist()))
            copied = set(by_words[: n - _least(COPIED, n) + 1].tolist())
            paraphrased = min(ways, key=lambda found: counts[list(found)].sum()) if len(by_answer) else set()
            pairs.update((w, at) for w in copied | paraphrased)
            reach[at] = -(-n // BLOCK)
            # Chernoff's bound tells which number of words is least likely to stand in a window by chance.
            k = np.arange(1, half + 1)
            held = np.array([counts[np.unique(by_words[: n - half + j])].sum() for j in k])
            chance = np.maximum(held / max(blocks, 1.0) * (4 * reach[at] + 3), 1e-9)
            least[at] = k[np.argmax(np.where(k > chance, k * np.log(k / chance) - k + chance, -1.0 / k))]
            rare[at, by_words[: n - half + least[at]]] = 1
            energy[at, [known[w] for w in item.energy]] = list(item.energy.values())
            # A copy has at least the energy of the words that have least of it; a little less for rounding.
            each = np.sort(energy[at, by_words] / np.bincount(by_words)[by_words])
            floor[at] = 0.999 * min(TELLING, each[: _least(COPIED, n)].sum())
        listed = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        starts = np.searchsorted(listed[:, 0], np.arange(len(known) + 1))
        return cls(starts, listed[:, 1], reach, least, rare, floor, energy)

    def around(self, b: Blocks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Blocks with an anchor and the words that must stand around it: text, block, and the item it may be of."""
        often = np.diff(self.starts)[b.ids]
        used = np.flatnonzero(often)
        often = often[used]
        place = np.arange(often.sum()) - np.repeat(np.cumsum(often) - often, often)
        item = self.items[np.repeat(self.starts[b.ids[used]], often) + place]
        block, item = np.divmod(np.unique(np.repeat(b.block[used], often) * len(self.least) + item), len(self.least))
        text = np.searchsorted(b.first, block, side="right") - 1
        # Energy counts once a word, so its repeats in a block are left out.
        for table, least, ids, blocks in (
            (self.rare, self.least, b.ids, b.block), (self.energy, self.floor, b.ids[b.new], b.block[b.new])
        ):
            kept = self._sums(table, ids, blocks, b.first, text, block, item) >= least[item]
            text, block, item = text[kept], block[kept], item[kept]
        return text, block, item

    def _sums(self, table: np.ndarray, ids: np.ndarray, blocks: np.ndarray, first: np.ndarray, text, block, item) -> np.ndarray:
        """What the words that any region with the block has add up to in the item's row of the table."""
        begins = np.searchsorted(blocks, np.maximum(first[text], block - 1 - 2 * self.reach[item]))
        sizes = np.searchsorted(blocks, np.minimum(first[text + 1], block + 2 + 2 * self.reach[item])) - begins
        out, ends = np.zeros(len(block)), np.cumsum(sizes)
        cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1] if len(ends) else 0, _LOOKED)))
        for low, high in zip(cuts, [*cuts[1:], len(block)]):
            part, start = sizes[low:high], np.cumsum(sizes[low:high]) - sizes[low:high]
            at = np.arange(part.sum()) + np.repeat(begins[low:high] - start, part)
            out[low:high] = np.add.reduceat(table[np.repeat(item[low:high], part), ids[at]], start, dtype=np.float32)
        return out


@dataclass
class Space:
    """What the search needs: TF-IDF weights times the latent axes, squared weights, and the items' vectors and words."""

    known: dict[bytes, int]
    projection: np.ndarray
    squares: np.ndarray
    unknown: float
    items: list[Item]
    pieces: np.ndarray
    owner: np.ndarray
    needed: Needed

    def candidates(self, b: Blocks, rows: np.ndarray, near: np.ndarray) -> dict[tuple[int, int], bool]:
        """Passages and items to verify, and whether they are near: all that are, and all that can count by their words.

        ``near`` has the cosines of the passages of ``rows``; no other is near anything.
        """
        whole, out = b.whole(), {}
        texts, blocks, found = self.needed.around(b)
        for text, block, at, first, end in zip(*(x.tolist() for x in (texts, blocks, found, b.first[texts], b.first[texts + 1]))):
            item, reach = self.items[at], int(self.needed.reach[at])
            n, low, high = len(item.words), block - 1 - reach, block + reach
            around = b.texts[text][max(0, (low - first) * BLOCK - n) : (high + 2 - first) * BLOCK + n]
            share = common_subsequence(item.masks[0], n, around) / n
            if share >= COPIED or share >= PARAPHRASED and item.telling(around) >= TELLING:
                out.update(((row, at), False) for row in range(max(first, low), min(end, high + 1)) if whole[row])
        places, columns = np.divmod(np.flatnonzero(near >= CANDIDATE), max(1, near.shape[1]))
        out.update(((row, at), True) for row, at in zip(rows[places].tolist(), self.owner[columns].tolist()))
        return out

    def search(self, texts: list[str | None]) -> list[list[tuple[int, float, float]]]:
        """Per text the items found in it: item, cosine and share of the item's words in order."""
        b = Blocks.of(texts, self.known)
        vectors = b.paired(b.sums(self.projection))
        weights = np.bincount(b.block, weights=self.squares[b.ids], minlength=b.n) + b.unknown * self.unknown
        within = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        length = np.maximum(np.maximum(np.sqrt(b.paired(weights)), within), 1e-9)
        # No cosine is above what of the passage lies in the latent space; a little less for rounding.
        rows = np.flatnonzero(b.whole() & (within >= 0.999 * CANDIDATE * length))
        units = vectors[rows]
        units /= length[rows].astype(np.float32)[:, None]
        near = units @ self.pieces.T
        best: dict[tuple[int, int], tuple[float, float]] = {}
        for (row, at), close in self.candidates(b, rows, near).items():
            text = int(np.searchsorted(b.first, row, side="right")) - 1
            item, start = self.items[at], (row - int(b.first[text])) * BLOCK
            margin = len(item.words)
            region = b.texts[text][max(0, start - margin) : start + 2 * BLOCK + margin]
            share, answered = item.shares(region)
            if share >= COPIED or share >= PARAPHRASED and answered >= ANSWERED and (close or item.telling(region) >= TELLING):
                cosine, most = best.get((text, at), (0.0, 0.0))
                here = vectors[row] / np.float32(length[row])
                best[text, at] = max(cosine, float((self.pieces[self.owner == at] @ here).max())), max(most, share)
        out: list[list[tuple[int, float, float]]] = [[] for _ in texts]
        for (text, at), (cosine, share) in best.items():
            out[text].append((self.items[at].item_id, min(1.0, cosine), share))
        return [sorted(found) for found in out]


def fit(docs: DataFrame, items: list[Item], texts: list[str], seed: int = 42) -> Space:
    """The latent space of one set of items: two passes over the words of all documents, for weights and for the sketch."""
    spark = docs.sparkSession
    context = spark.sparkContext
    vocabulary = sorted({w for item in items for w in item.words})
    size = len(vocabulary)
    shared = context.broadcast({w: i for i, w in enumerate(vocabulary)})
    rows = docs.select(F.col("text").cast("string").alias("text"))
    kept = materialize(rows.mapInArrow(_numbered(shared), "ids binary"), "benchmark-words")
    counts = kept.mapInArrow(_document_counts(size), "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).toArrow()
    held = np.zeros(size + 1)
    held[counts["f"].to_numpy()] = counts["n"].to_numpy()
    # Numbered anew by frequency.
    order = np.argsort(-held[:-1], kind="stable")
    known = {vocabulary[i]: place for place, i in enumerate(order)}
    idf = np.log((held[-1] + 2) / (held[:-1][order] + 1)) + 0.05
    width = min(DIMENSIONS + OVERSAMPLED, size)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, width)))[0]
    space = context.broadcast((np.argsort(order), idf, basis))
    names = [f"y{j}" for j in range(width)]
    sketched = kept.mapInArrow(_sketch(space), "f long, " + ", ".join(f"{n} double" for n in names))
    # One row per word of the benchmark.
    summed = sketched.groupBy("f").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    matrix, at = np.column_stack([summed[n].to_numpy() for n in names]), summed["f"].to_numpy()
    image = np.zeros((size, width))
    image[at[at >= 0]] = matrix[at >= 0]
    energy = float(matrix[at < 0].max()) if (at < 0).any() else 0.0
    own = Blocks.of(texts, known)
    used = own.whole()
    lengths = own.paired(np.bincount(own.block, weights=idf[own.ids] ** 2, minlength=own.n))
    # Every passage of the benchmark counts alike, whatever its length.
    part, _ = _gram_times(own, idf, basis, np.where(used, 1 / np.maximum(lengths, 1e-9), 0.0))
    image += part * (BENCHMARK_SHARE * energy / used.sum() if energy else 1.0)
    axes = _leading(image, basis, DIMENSIONS)
    projection = (idf[:, None] * axes).astype(np.float32)
    pieces = own.paired(own.sums(projection))[used]
    owner = np.repeat(np.arange(len(items)), np.diff(own.first))[used]
    pieces /= np.maximum(np.linalg.norm(pieces, axis=1, keepdims=True), 1e-9)
    for item in items:
        held_by = {w: float(idf[known[w]]) ** 2 for w in item.words}
        item.energy = {w: e / sum(held_by.values()) for w, e in held_by.items()}
    needed = Needed.of(items, known, held[:-1][order], held[-1])
    return Space(known, projection, idf**2, float(np.log(held[-1] + 2) + 0.05) ** 2, items, pieces, owner, needed)


FOUND = "array<struct<item_id:bigint,cosine:double,share:double>>"


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with all its columns in ``row`` and the items found in each text in ``found``.

    ``found`` lists ``item_id``, the cosine of the best candidate and the share of the item's words that
    stand in order, by ``item_id``; it is empty for a clean document. ``benchmark`` has ``item_id`` and
    ``text``; it is taken in sets of about ``ITEMS`` items, each searched in all documents. Items without words
    and null texts match nothing; repeated rows are searched each; empty tables give no rows or no finds.
    """
    spark = docs.sparkSession
    texts = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string").alias("text")).where("text is not null")
    sets = -(-texts.count() // ITEMS)
    out = docs.select(F.struct("*").alias("row"), F.array().cast(FOUND).alias("found"))
    row_type = out.schema["row"].dataType.simpleString()
    for k in range(sets):
        rows = texts.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(sets)) == k).orderBy("item_id", "text").collect()
        rows = [r for r in rows if words(r.text)]
        if not rows:
            continue
        space = spark.sparkContext.broadcast(fit(docs, [Item(r.item_id, words(r.text), answer(r.text)) for r in rows], [r.text for r in rows]))

        def searched(batches: Iterator[pa.RecordBatch], space=space) -> Iterator[pa.RecordBatch]:
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("share", pa.float64())]))
            for batch in batches:
                hits = space.value.search(batch.column("row").field("text").to_pylist())
                before = batch.column("found").to_pylist()
                both = [
                    b + [{"item_id": i, "cosine": c, "share": s} for i, c, s in found] for b, found in zip(before, hits)
                ]
                yield pa.record_batch([batch.column("row"), pa.array(both, kind)], ["row", "found"])

        out = out.mapInArrow(searched, f"row {row_type}, found {FOUND}")
    return out.withColumn("found", F.array_sort("found"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item was found, with their columns unchanged."""
    return find(docs, benchmark).where(F.size("found") == 0).select("row.*")
