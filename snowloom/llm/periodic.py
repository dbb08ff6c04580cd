"""Runs: stretches of words that repeat with a period, and texts with each run cut to its first period.

A run is a stretch of consecutive words with smallest period q, at least ``max(LEAST, 3 * q)`` words long, which
no neighbouring word extends. Every text is read by itself, so nothing is shuffled.

Runs are found with a suffix automaton. Its suffix links are a tree; words are appended one by one, and each
prefix recolours the path from its state to the root with its own end, by the access operation of link-cut trees.
The path falls into segments last coloured by the same earlier prefix. A segment that prefix ``e`` coloured and
whose longest string has ``m`` words tells that the last ``m`` words before ``i`` also end at ``e``, and nowhere between:
with ``i - e <= m`` the last ``m + i - e`` words are a square and more of smallest period ``i - e``. Squares with one
beginning and one period belong to one run. All accesses together meet O(n log n) segments.

The automaton is built only over the stretches of a text that can hold a run: in a run of ``l`` words and period q
each of the first ``l - q - 7`` eight-word windows, nine at least, occurs again within q words, so those places are
marked side by side and none looks farther ahead than half their number and a few words. Places of which that is
not true are unmarked until nothing changes; no run is lost by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snowloom.llm import native
from snowloom.llm.substrings import word_codes

# The shortest run, in words, and how many periods it has at least.
LEAST = 24
PERIODS = 3
# Words in the windows that mark where a run can be.
_GRAM = 8
# Unmarking may stop early: it only saves work.
_ROUNDS = 64
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = (left * _MIX[0]) ^ (right + (left >> np.uint64(29)))
    x = (x ^ (x >> np.uint64(32))) * _MIX[1]
    return x ^ (x >> np.uint64(32))


def _bounds(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of every stretch of set flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2] - 1


def stretches(codes: np.ndarray) -> list[tuple[int, int]]:
    """``(first, end)`` of stretches of words such that every run lies whole in one of them."""
    n = len(codes)
    if n < LEAST:
        return []
    grams, width = codes, 1
    while width < _GRAM:
        grams = _joined(grams[:-width], grams[width:])
        width *= 2
    order = np.argsort(grams, kind="stable")
    same = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
    if not len(same):
        return []
    ahead = np.zeros(len(grams), np.int64)
    ahead[order[same]] = order[same + 1] - order[same]
    for _ in range(_ROUNDS):
        marked = ahead > 0
        first, last = _bounds(marked)
        size = np.zeros(len(grams), np.int64)
        size[marked] = np.repeat(last - first + 1, last - first + 1)
        off = marked & ((size < LEAST - LEAST // PERIODS - _GRAM + 1) | (2 * ahead - _GRAM + 1 > size))
        if not off.any():
            break
        ahead[off] = 0
    first, last = _bounds(ahead > 0)
    reach = (last - first + _GRAM) // 2 + _GRAM
    return [(int(a), int(min(n, b + 1 + r))) for a, b, r in zip(first, last, reach)]


class _Automaton:
    """Suffix automaton of a sequence of words: suffix links, longest lengths, the state of every prefix.

    States are numbered from 1, the empty string's, so that 0 can stand for none.
    """

    def __init__(self, words: list):
        self.link, self.longest, self.prefix = [0, 0], [0, 0], []
        link, longest, prefix = self.link, self.longest, self.prefix
        follow: list[dict] = [{}, {}]
        last = 1
        for word in words:
            state = len(link)
            longest.append(longest[last] + 1)
            follow.append({})
            link.append(1)
            prefix.append(state)
            at = last
            while at and word not in follow[at]:
                follow[at][word] = state
                at = link[at]
            if at:
                met = follow[at][word]
                if longest[met] == longest[at] + 1:
                    link[state] = met
                else:
                    twin = len(link)
                    longest.append(longest[at] + 1)
                    follow.append(dict(follow[met]))
                    link.append(link[met])
                    while at and follow[at].get(word) == met:
                        follow[at][word] = twin
                        at = link[at]
                    link[met] = link[state] = twin
            last = state


class _LastEnds:
    """Link-cut trees over the suffix links: each preferred path has been coloured by one prefix.

    A path is a splay tree ordered by depth; its colour stands at the tree's root.
    """

    def __init__(self, automaton: _Automaton):
        size = len(automaton.link)
        self.up = list(automaton.link)
        self.left, self.right = [0] * size, [0] * size
        self.colour = [-1] * size
        self.longest = automaton.longest

    def _splay(self, x: int) -> None:
        """Make ``x`` the root of its path's tree and let it bear the path's colour."""
        up, left, right = self.up, self.left, self.right
        root = x
        while (f := up[root]) and (left[f] == root or right[f] == root):
            root = f
        if root == x:
            return
        self.colour[x] = self.colour[root]
        above = up[root]
        while (f := up[x]) != above:
            g = up[f]
            if g != above and (left[g] == f) == (left[f] == x):
                self._rotate(f)
            elif g != above:
                self._rotate(x)
                f = up[x]
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        f = up[x]
        g = up[f]
        if left[f] == x:
            left[f] = inner = right[x]
            right[x] = f
        else:
            right[f] = inner = left[x]
            left[x] = f
        if inner:
            up[inner] = f
        up[f], up[x] = x, g
        if left[g] == f:
            left[g] = x
        elif right[g] == f:
            right[g] = x

    def recolour(self, state: int, end: int) -> Iterator[tuple[int, int]]:
        """Colour the path from ``state`` to the root with ``end``; ``(earlier end, longest length)`` per segment."""
        up, right, colour = self.up, self.right, self.colour
        below = 0
        while state:
            self._splay(state)
            before = colour[state]
            if before >= 0:
                yield before, self.longest[state]
            if right[state]:
                colour[right[state]] = before
            right[state] = below
            below, state = state, up[state]
        colour[below] = end


def runs(words: list, codes: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs of one text as ``(start, length, period)``, by start, then period. ``codes`` has a hash per word."""
    found, n = set(), len(words)
    for first, end in stretches(codes):
        part = words[first:end]
        automaton = _Automaton(part)
        ends = _LastEnds(automaton)
        squares: dict[tuple[int, int], int] = {}
        for i, state in enumerate(automaton.prefix):
            for before, longest in ends.recolour(state, i):
                period = i - before
                if period <= longest and longest + period >= max(LEAST, PERIODS * period):
                    squares[i - longest - period + 1, period] = i
        for (start, period), last in squares.items():
            start, last = start + first, last + first
            while start and words[start - 1] == words[start - 1 + period]:
                start -= 1
            while last + 1 < n and words[last + 1] == words[last + 1 - period]:
                last += 1
            found.add((start, last - start + 1, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    return min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _named(run: tuple[int, int, int] | None) -> dict | None:
    return run and dict(zip(("start", "length", "period"), run))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals, all_, best, texts = [], [], [], []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            words = (text or b"").split()
            found = runs(words, word_codes(text)) if len(words) >= LEAST else []
            if found:
                gone = np.zeros(len(words) + 1, np.int64)
                for start, length, period in found:
                    gone[start + period] += 1
                    gone[start + length] -= 1
                kept = [w for w, g in zip(words, (np.cumsum(gone) > 0).tolist()) if not g]
            else:
                kept = words
            totals.append(len(words))
            all_.append([_named(r) for r in found])
            best.append(_named(_strongest(found)))
            texts.append(b" ".join(kept))
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(all_, pa.list_(_RUN)), pa.array(best, _RUN), pa.array(texts, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "runs", "strongest", "collapsed"],
        )


def find_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, runs, strongest, collapsed)`` for every row of ``docs`` (needs ``doc_id``, ``text``).

    ``runs`` has ``start`` (word number from 0), ``length`` and ``period`` of every run, by start, then period;
    ``strongest`` the one of greatest length by period (ties: smallest start, then period; no run: null);
    ``collapsed`` the words that no run contains after its first period, joined by one blank. Words are runs of
    anything but ASCII white space, as written. A null text has no words; rows with equal texts are read one by one;
    other columns are left out, whatever their names; an empty table gives no rows. A text is held by one task,
    with some 0.3 kB for every word of a stretch that can hold a run, up to twice that if most states are split.
    """
    ids = docs.schema["doc_id"].dataType.simpleString()
    run = "struct<start:long,length:long,period:long>"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _read, f"doc_id {ids}, n_words long, runs array<{run}>, strongest {run}, collapsed string"
    )


def with_planted_runs(text: Column, doc_id: Column) -> Column:
    """The text, in one of ten documents with a period planted from some word to the end.

    With h the unsigned crc32 of the decimal id and g = h / 10: if h % 10 = 0, each word i >= a becomes word
    a + (i - a) % p, where a = g % n and p = 1 + (n - a) / (3 + g % 8), divisions rounded down.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def planted(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        moved = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.element_at(words, (at(i) + 1).cast("int")))
        return F.when(n > 0, F.array_join(moved, " ")).otherwise(text)

    return F.when((h % 10 == 0) & text.isNotNull(), native.let(native.words(text), planted)).otherwise(text)
