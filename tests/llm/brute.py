"""Direct versions of the operators over lists, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

_BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def words(text: str | None) -> list[str]:
    return [w for w in re.split(f"[{_BLANKS}]+", text or "") if w]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def simhash(text: str | None) -> int:
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: list[int], ids: list[int | None]) -> list[int | None]:
    """The smallest id reachable from every row over prints at most two bits apart."""
    root = list(range(len(prints)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(prints))]


def without_repeats(texts: list[str | None], window: int) -> list[tuple[int, int, str]]:
    """Words, words removed and what is left of every text."""
    cut = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in cut for i in range(len(w) - window + 1))
    out = []
    for w in cut:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def jaccard(a: str, b: str) -> float:
    x, y = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (words(a), words(b)))
    return len(x & y) / len(x | y)


def edited(text: str, following: str) -> str:
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def token_rows(docs: list[tuple[int | None, str | None]], tokenizer) -> list[tuple]:
    out, start = [], 0
    for doc_id, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def runs(w: list[str]) -> list[tuple[int, int, int]]:
    """Maximal stretches of smallest period q, 24 words and three periods long at least, as (start, length, q)."""
    out, n = [], len(w)
    for q in range(1, n // 3 + 1):
        start = 0
        for i in range(n - q + 1):
            if i + q == n or w[i] != w[i + q]:
                length = i - start + q
                if length >= max(24, 3 * q):
                    least = next(p for p in range(1, q + 1) if all(w[x] == w[x + p] for x in range(start, start + length - p)))
                    if least == q:
                        out.append((start, length, q))
                start = i + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def without_runs(w: list[str], found: list[tuple[int, int, int]]) -> str:
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(w: list[str], doc_id: int | None) -> list[str]:
    """The words with a period planted if the id asks for one."""
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is None or h % 10 or not n:
        return w
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def collocations(docs: list[tuple[str | None, str | None]], longest: int, least: int, contained: int) -> list[tuple]:
    """Every kept phrase as (lang, phrase, a, l, r, n, score), ranked."""
    f: dict[str, Counter] = {}
    n = Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.setdefault(lang, Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        covered = {
            p[i : i + k] for p, a in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= contained * count[p[i : i + k]]
        }
        for p, a in candidates.items():
            if p not in covered:
                score, k = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
                out.append((lang, " ".join(p), a, count[p[:k]], count[p[k:]], n[lang], score))
    return sorted(out, key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
