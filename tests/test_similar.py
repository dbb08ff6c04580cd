"""Nearly equal names against all pairs."""

import random

import pytest

from snowloom.operators import similar
from snowloom.plans import fixed_values as fixed


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def direct(left, right, distance):
    return sorted((a, b, d) for a in {x for x in left if x is not None} for b in {x for x in right if x is not None} if (d := edits(a, b)) <= distance)


def found(spark, left, right, distance):
    frames = [spark.createDataFrame([(x,) for x in side], "v string") for side in (left, right)]
    return sorted(tuple(r) for r in similar.near_names(*frames, distance).collect())


@pytest.mark.parametrize("distance, seed", [(1, 1), (2, 2), (3, 3)])
def test_equal_to_all_pairs(spark, distance, seed):
    """Short names, names of few letters, repeated grams, other alphabets."""
    rng = random.Random(seed)
    make = lambda: "".join(rng.choice("abé ") for _ in range(rng.randint(0, 9)))
    left = [make() for _ in range(60)] + [None, "", "abababababab", "a" * 20, "München"]
    right = [make() for _ in range(60)] + [None, "babababababa", "a" * 18, "abababab", "Munchen", "münchen "]
    want = direct(left, right, distance)
    assert len(want) > 20 and found(spark, left, right, distance) == want
    assert found(spark, [], right, distance) == [] == found(spark, left, [None], distance)


def test_fixed_overrides(spark):
    """Misspelt names of cities in the fixed list, against the names that stand for them."""
    pairs = [(mis.strip(), orig.strip()) for mis, orig, *_ in fixed.CITY_OVERRIDES]
    got = {(a, b) for a, b, _ in found(spark, [a for a, _ in pairs], [b for _, b in pairs], 2)}
    within = {(a, b) for a, b in pairs if edits(a, b) <= 2}
    # The others are districts, suffixes and other names of a place, which no distance finds.
    assert within <= got and (len(within), len(pairs)) == (28, 154)
