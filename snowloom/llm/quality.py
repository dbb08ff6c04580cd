"""Quality by nearest-neighbour voting among labelled documents in a latent-semantic space.

Features of a document are its lower-cased words, the shapes of its words as written, and marks of
repetition, each hashed to one of ``FEATURES`` numbers. Their TF-IDF weights are projected on the leading
singular vectors of a bounded labelled sample; its vectors are broadcast, and every document is compared
with all of them by blocked cosine products.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowloom.llm.labelled import fold, labelled
from snowloom.session import materialize

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
FEATURES = 1 << 14
DIMENSIONS = 48
# Labelled documents at most that vote, half of each label where there are as many. Bounds what is broadcast:
# a vector of DIMENSIONS floats each.
VOTERS = 6000
NEIGHBOURS = 15
# Votes are weighted by the cosine to this power.
SHARPNESS = 4
_HELD_WORDS = 200_000
# A shape keeps punctuation, writes upper and lower case and digits as one letter each, and runs once.
_CLASSES = bytes(
    65 if 65 <= b < 91 else 97 if 97 <= b < 123 or b >= 128 else 48 if 48 <= b < 58 else b for b in range(256)
)
_RUNS = re.compile(rb"(.)\1+", re.DOTALL)
# A shape counts this often as much as a word, as there are far fewer of them.
SHAPE_WEIGHT = 3.0


def _number(name: bytes) -> int:
    return xxhash.xxh64_intdigest(name) % FEATURES


_EMPTY = _number(b"empty")
_MARKS = np.array([_number(b"m " + m) for m in (b"again", b"few", b"lines", b"caps")])


class Numbers(dict):
    """The feature numbers of a word, of itself in lower case and of its shape, and whether it is in capitals,
    as one whole number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _HELD_WORDS:
            self.clear()
        shape = _RUNS.sub(rb"\1", word.translate(_CLASSES))
        code = (_number(b"w " + word.lower()) * FEATURES + _number(b"s " + shape[:12])) * 2 + word.isupper()
        self[word] = code
        return code


def counted(text: str, numbers: Numbers) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of a text and their weights before IDF: one plus the logarithm of the count."""
    words = text.encode("utf-8", "replace").split()
    n = len(words)
    if not n:
        return np.array([_EMPTY]), np.ones(1)
    codes = np.fromiter(map(numbers.__getitem__, words), np.int64, n)
    of_words = codes // (2 * FEATURES)
    times = np.bincount(of_words, minlength=1)
    shown = np.bincount(codes // 2 % FEATURES, minlength=1)
    own, shapes = np.flatnonzero(times), np.flatnonzero(shown)
    # Repetition of the word before, little variety, short lines, capitals: each as a share of the words.
    marks = [
        float((of_words[1:] == of_words[:-1]).mean()) if n > 1 else 0.0,
        1 - len(own) / n if n >= 20 else 0.0,
        min(1.0, (text.count("\n") + 1) / n * 5),
        float((codes % 2).mean()),
    ]
    level = SHAPE_WEIGHT * np.sqrt(n)
    weights = [1 + np.log(times[own]), level / n * shown[shapes], level * np.array(marks)]
    return np.concatenate([own, shapes, _MARKS]), np.concatenate(weights)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers, held, n = Numbers(), np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            ids, weights = counted(text or "", numbers)
            held[np.unique(ids[weights > 0])] += 1
            n += 1
    at = np.flatnonzero(held)
    yield pa.record_batch([pa.array(np.append(at, -1)), pa.array(np.append(held[at], n))], ["f", "n"])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = Numbers()
    for batch in batches:
        rows = [counted(t, numbers) for t in batch.column("text").to_pylist()]
        yield pa.record_batch(
            [batch.column("doc_id"), batch.column("y"), pa.array([r[0] for r in rows], pa.list_(pa.int64())), pa.array([r[1] for r in rows], pa.list_(pa.float64()))],
            ["doc_id", "y", "ids", "weights"],
        )


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column as views of its values, without an object per number."""
    return [
        part for chunk in column.chunks for part in np.split(chunk.flatten().to_numpy(), np.cumsum(chunk.value_lengths().to_numpy())[:-1])
        if len(chunk)
    ]


@dataclass
class Space:
    """What scoring needs: feature weights times projection, the voters' unit vectors and their labels."""

    projection: np.ndarray
    voters: np.ndarray
    labels: np.ndarray
    prior: float

    def vectors(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        out = np.array([w @ self.projection[i] for i, w in rows], np.float32).reshape(len(rows), -1)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest voters; the prior if none is similar."""
        if not len(self.voters):
            return np.full(len(rows), self.prior)
        near = self.vectors(rows) @ self.voters.T
        k = min(NEIGHBOURS, near.shape[1])
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weights = np.maximum(np.take_along_axis(near, top, axis=1), 0.0).astype(np.float64) ** SHARPNESS
        total = weights.sum(axis=1)
        return np.where(total > 1e-9, (weights * self.labels[top]).sum(axis=1) / np.maximum(total, 1e-9), self.prior)


def _singular_vectors(rows: list[tuple[np.ndarray, np.ndarray]], d: int, seed: int = 42) -> np.ndarray:
    """Leading right singular vectors of the sparse rows, by randomised subspace iteration."""
    random = np.random.default_rng(seed)
    basis = random.standard_normal((FEATURES, d + 8)).astype(np.float32)
    for _ in range(4):
        image = np.zeros((FEATURES, basis.shape[1]), np.float64)
        for ids, weights in rows:
            image[ids] += np.outer(weights, weights @ basis[ids])
        basis = np.linalg.qr(image)[0].astype(np.float32)
    small = np.array([w @ basis[i] for i, w in rows])
    return basis @ np.linalg.svd(small, full_matrices=False)[2].T[:, :d].astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame) -> Space:
    """Document counts over all of ``docs``, then the space and its voters from the labelled sample."""
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counts = texts.mapInArrow(_document_counts, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).toArrow()
    held = np.zeros(FEATURES + 1)
    held[counts["f"].to_numpy()] = counts["n"].to_numpy()
    idf = np.log((held[-1] + 1) / (held[:FEATURES] + 1)) + 0.1
    usable = fold(F.col("doc_id"), FOLDS) != HELD_OUT
    ids = labels.where(usable & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    # Chosen by hash before any text is read; the frames of ids hold VOTERS / 2 rows each.
    chosen = [ids.where(F.col("quality") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(VOTERS // 2) for y in (0, 1)]
    sample = materialize(chosen[0].unionByName(chosen[1]), "quality-sample")
    few = labelled(docs, sample, "quality", usable).select("doc_id", "y", "text")
    kinds = f"doc_id {few.schema['doc_id'].dataType.simpleString()}, y int, ids array<long>, weights array<double>"
    got = few.mapInArrow(_sampled, kinds).limit(VOTERS).toArrow().sort_by("doc_id")
    y = got["y"].to_numpy().astype(float)
    plain = list(zip(_arrays(got["ids"]), _arrays(got["weights"])))
    rows = [(i, w * idf[i]) for i, w in plain]
    rows = [(i, w / max(np.linalg.norm(w), 1e-12)) for i, w in rows]
    prior = float(y.mean()) if len(y) else 0.0
    if not rows:
        return Space(np.zeros((FEATURES, 1), np.float32), np.zeros((0, 1), np.float32), y, prior)
    axes = _singular_vectors(rows, min(DIMENSIONS, len(rows)))
    space = Space((idf[:, None] * axes).astype(np.float32), np.zeros((0, 1), np.float32), y, prior)
    space.voters = space.vectors(plain)
    return space


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with all its columns in ``row``, and beside them ``held_out, score, predicted``.

    ``score`` is the share of label 1 among the nearest voters. A null or empty text is a document of its
    own kind; repeated rows are scored each; an empty table gives none; without labels every score is 0.
    """
    space = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = space.value.scores([counted(t or "", numbers) for t in texts])
            yield pa.record_batch([batch.column("row"), pa.array(found, pa.float64())], ["row", "score"])

    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    row_type = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(scored, f"row {row_type}, score double").select(
        "row", (fold(F.col("row.doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be of low quality, with their columns unchanged."""
    return score(docs, labels).where("predicted = 1").select("row.*")
