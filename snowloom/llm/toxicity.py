"""Toxicity by two Kneser-Ney models, one of toxic and one of ordinary documents.

An expression is a lower-cased word. A class model interpolates three orders: the word by the number of
documents of the class that hold it, then its leading five and four bytes by the number of different words of
the class that begin so (Kneser-Ney's continuation counts), then a share that both classes have in common.
Every order discounts its counts and gives the rest to the next; how an order spreads over the words of a
beginning is counted over both classes, so a rare expression gets from both models what is shared and differs
only as far as its beginning does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snowloom.llm.labelled import fit_logistic, fold, labelled, logistic
from snowloom.session import materialize

FOLDS, HELD_OUT, CALIBRATION = 4, 2, 3
THRESHOLD = 0.3
PREFIXES = (5, 4)
# Weight that every order leaves to the next.
BACKOFF = 0.25
# A word stands in the model on its own from so many documents on, else by its beginning.
LEAST_DOCUMENTS = 3
# Labelled documents at most that the calibration is fitted on.
CALIBRATED = 20_000
_HELD_WORDS = 200_000
_SEED = 42
_SPACED = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))


def expressions(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_SPACED).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per word and class, summed over what a task holds of ``_HELD_WORDS`` words at a time."""
    held: dict[bytes, list[int]] = {}

    def out() -> pa.RecordBatch:
        counts = np.array(list(held.values()), np.int64).reshape(-1, 2)
        return pa.record_batch([pa.array(list(held), pa.binary()), pa.array(counts[:, 0]), pa.array(counts[:, 1])], ["word", "o", "t"])

    for batch in batches:
        for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
            for word in set(expressions(text)):
                held.setdefault(word, [0, 0])[y] += 1
            if len(held) >= _HELD_WORDS:
                yield out()
                held.clear()
    yield out()


def _interpolated(count: Column, total: Column, spread: Column, lower: Column, discount: float) -> Column:
    return (1 - BACKOFF) * F.greatest(count - discount, F.lit(0.0)) / F.greatest(total, F.lit(1e-9)) * spread + BACKOFF * lower


def _table(rows: DataFrame, key: str) -> dict[str, np.ndarray]:
    """The table of one order, by the hash of the key: 12 bytes a row, all rows of it, sent to every task."""
    table = rows.select(F.xxhash64(key).alias("h"), F.log(F.col("pt") / F.col("po")).cast("float").alias("r")).toArrow()
    names, values = table["h"].to_numpy().view(np.uint64), table["r"].to_numpy()
    order = np.argsort(names)
    return {"names": names[order], "values": values[order]}


def fit(counts: DataFrame) -> list[dict[str, np.ndarray]]:
    """The tables of log ratios per order, words first, from ``(word, o, t)`` with one row per word."""
    p5, p4 = (F.substring("word", 1, n) for n in PREFIXES)
    words = counts.select("word", p5.alias("p5"), p4.alias("p4"), "o", "t")
    by5 = words.groupBy("p5", "p4").agg(*_types())
    by5 = materialize(by5, "toxicity-prefixes")
    by4 = by5.groupBy("p4").agg(F.sum("o").alias("o"), F.sum("t").alias("t"), F.sum("n").alias("n"))

    def of(rows: DataFrame, discount: float, lower: dict[str, Column], spread: Column) -> DataFrame:
        held = [F.sum(F.greatest(F.col(c) - discount, F.lit(0.0))).alias(f"sum_{c}") for c in ("o", "t")]
        sums = rows.agg(*held).first()
        return rows.select(
            "*", *[_interpolated(F.col(c), F.lit(sums[f"sum_{c}"] or 0.0), spread, lower[c], discount).alias(f"p{c}") for c in ("o", "t")]
        )

    totals = counts.agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("o") + F.col("t") == 1).cast("int")).alias("n1"),
        F.sum((F.col("o") + F.col("t") == 2).cast("int")).alias("n2"),
    ).first()
    n1, n2 = totals.n1 or 0, totals.n2 or 0
    discount = min(0.95, max(0.5, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.75
    shared = F.lit(1.0 / max(1, totals.n))
    spread = 1 / F.greatest(F.col("n"), F.lit(1)).cast("double")
    four = of(by4, discount, {"o": shared, "t": shared}, spread)
    low4 = four.select(F.col("p4").alias("k4"), F.col("po").alias("lo"), F.col("pt").alias("lt"))
    lower = {"o": F.col("lo"), "t": F.col("lt")}
    five = of(by5.join(low4, by5.p4 == low4.k4), discount, lower, spread).drop("lo", "lt", "k4")
    low5 = five.select(F.col("p5").alias("k5"), F.col("po").alias("lo"), F.col("pt").alias("lt"))
    own = words.where(F.col("o") + F.col("t") >= LEAST_DOCUMENTS)
    # What the word order holds is counted over all words, also those that back off.
    sums = counts.agg(*[F.sum(F.greatest(F.col(c) - discount, F.lit(0.0))).alias(c) for c in ("o", "t")]).first()
    one = own.join(low5, own.p5 == low5.k5).select(
        "word",
        *[_interpolated(F.col(c), F.lit(sums[c] or 0.0), F.lit(1.0), lower[c], discount).alias(f"p{c}") for c in ("o", "t")],
    )
    return [_table(one, "word"), _table(five, "p5"), _table(four, "p4")]


def _types() -> list[Column]:
    """Different words per class and over both."""
    held = [F.sum((F.col(c) > 0).cast("long")).alias(c) for c in ("o", "t")]
    return [*held, F.count(F.lit(1)).alias("n")]


class LogRatios(dict):
    """Log ratio of the two models by word: looked up once, remembered for a bounded number of words."""

    def __init__(self, tables: list[dict[str, np.ndarray]]):
        self.orders = [(None if i == 0 else PREFIXES[i - 1], t["names"], t["values"]) for i, t in enumerate(tables)]

    def __missing__(self, word: bytes) -> float:
        if len(self) >= _HELD_WORDS:
            self.clear()
        found = 0.0
        for length, names, values in self.orders:
            name = np.uint64(xxhash.xxh64_intdigest(word[:length], _SEED))
            at = names.searchsorted(name)
            if at < len(names) and names[at] == name:
                found = float(values[at])
                break
        self[word] = found
        return found


FEATURES = 6


def features(ratios: np.ndarray) -> tuple[float, ...]:
    """Length-normalised log-likelihood differences: of the text, of its strongest windows of 32 and 8 words,
    of what single expressions have beyond 2; the share of expressions beyond 3; and the text's length."""
    n = len(ratios)
    if not n:
        return (0.0,) * FEATURES
    sums = np.concatenate([[0.0], np.cumsum(ratios)])
    strongest = [float((sums[w:] - sums[:-w]).max() / w) for w in (min(n, 32), min(n, 8))]
    beyond = float(np.maximum(ratios - 2, 0).mean())
    return (float(ratios.mean()), *strongest, beyond, float((ratios > 3).mean()), float(np.log1p(n)))


def _featured(tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = LogRatios(tables.value)
        for batch in batches:
            rows = [
                features(np.array([ratios[w] for w in expressions(t or "")], np.float64)) for t in batch.column("text").to_pylist()
            ]
            kept = [c for c in batch.schema.names if c != "text"]
            found = pa.array(rows, pa.list_(pa.float64()))
            yield pa.record_batch([*(batch.column(c) for c in kept), found], [*kept, "x"])

    return run


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``, by ``labels`` (``doc_id, toxic``).

    Labels of the held-out fold are never read; of the others one fold calibrates the score and the rest
    gives the counts, all of them. A null or empty text has no expressions and gets the score of that;
    repeated rows are scored each; an empty table gives none. Without toxic or without ordinary labels
    nothing can be told apart, and scores are near 0 or 1 as the labels there are.
    """
    spark, ids = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    known = materialize(labelled(docs, labels, "toxic", fold(F.col("doc_id"), FOLDS) != HELD_OUT, "merge"), "toxicity-labelled")
    calibrating = fold(F.col("doc_id"), FOLDS) == CALIBRATION
    part = known.where(~calibrating).select("text", "y").mapInArrow(_count, "word binary, o long, t long")
    counts = materialize(part.groupBy("word").agg(F.sum("o").alias("o"), F.sum("t").alias("t")), "toxicity-counts")
    tables = spark.sparkContext.broadcast(fit(counts))
    featured = _featured(tables)
    # Chosen by hash where there are more than may come to the driver.
    share = CALIBRATED / max(1, known.where(calibrating).count())
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(900_000 * share) if share < 1 else F.lit(True)
    sample = known.where(calibrating & drawn).select("doc_id", "y", "text")
    rows = sample.mapInArrow(featured, f"doc_id {ids}, y int, x array<double>").limit(CALIBRATED).toArrow().sort_by("doc_id")
    x = np.array(rows["x"].to_pylist(), np.float64).reshape(-1, FEATURES)
    weights = fit_logistic(x, rows["y"].to_numpy().astype(float))
    all_docs = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    scored = all_docs.mapInArrow(featured, f"doc_id {ids}, x array<double>")
    z = F.lit(float(weights[-1]))
    for i in range(FEATURES):
        z = z + F.col("x")[i] * float(weights[i])
    p = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(35.0)), F.lit(-35.0))))
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), p.alias("score"),
        (p >= THRESHOLD).cast("int").alias("predicted"),
    )
