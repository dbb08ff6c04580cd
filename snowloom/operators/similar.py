"""Names that are nearly alike: candidates for those a dimension does not know."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snowloom.session import materialize

# Characters in a gram, and what stands before and behind a name.
GRAM = 2
_EDGE = "\x01"


def _grams(name: Column) -> Column:
    """The grams of a name with both ends marked, each with its number among equal ones, so that none repeats."""
    padded = F.concat(F.lit(_EDGE * (GRAM - 1)), name, F.lit(_EDGE * (GRAM - 1)))
    cut = F.transform(F.sequence(F.lit(1), F.char_length(padded) - (GRAM - 1)), lambda i: F.substring(padded, i, GRAM))
    before = lambda g, i: F.size(F.filter(F.slice(cut, 1, i), lambda h: h == g)).cast("string")
    return F.transform(cut, lambda g, i: F.concat_ws("\x02", g, before(g, i)))


def _shortened(name: Column, distance: int) -> Column:
    """A name and what is left of it without up to ``distance`` characters."""
    found = F.array(name)
    for _ in range(distance):
        less = F.flatten(F.transform(found, lambda x: F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(x), F.lit(1))), lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.char_length(x))))))
        found = F.array_distinct(F.concat(found, less))
    return found


def near_names(left: DataFrame, right: DataFrame, distance: int = 2) -> DataFrame:
    """``(name, candidate, distance)``: for every different ``name`` of ``left`` the names of ``right`` at most ``distance`` edits away.

    An edit adds, drops or changes one character. No pair is left out and none is looked at without need: of two names
    that near, one of them ``GRAM * distance`` characters long at least, the ``GRAM * distance + 1`` rarest grams of
    either have one in common; shorter ones have a remainder in common that both give by dropping as many
    characters. These are equality joins; what they find is verified. Null names are near nothing.
    """
    if distance < 1:
        raise ValueError("distance is at least 1")
    short = GRAM * distance + 1
    sides = []
    for frame, side in ((left, 0), (right, 1)):
        name = F.col(frame.columns[0]).cast("string").alias("name")
        sides.append(frame.select(name).where("name is not null").distinct().select("name", F.lit(side).alias("side"), F.char_length("name").alias("n")))
    names = materialize(sides[0].unionByName(sides[1]), "near-names")

    long = names.where(F.col("n") > short - distance).select("*", F.explode(_grams(F.col("name"))).alias("gram"))
    seen = long.groupBy("gram").agg(F.count(F.lit(1)).alias("seen"))
    order = F.array_sort(F.collect_list(F.struct("seen", "gram")))
    rarest = long.join(seen, "gram").groupBy("name", "side", "n").agg(F.slice(order, 1, GRAM * distance + 1).alias("first"))
    marked = materialize(rarest.select("name", "side", "n", F.explode("first").alias("g")).select("name", "side", "n", "g.gram"), "near-grams")
    rest = names.where(F.col("n") <= short + distance).select("name", "side", "n", F.explode(_shortened(F.col("name"), distance)).alias("gram"))

    def met(marks: DataFrame) -> DataFrame:
        a = marks.where("side = 0").select("name", "n", "gram")
        b = marks.where("side = 1").select(F.col("name").alias("candidate"), F.col("n").alias("m"), F.col("gram").alias("of"))
        near = (F.col("gram") == F.col("of")) & (F.abs(F.col("n") - F.col("m")) <= distance)
        return a.join(b, near).select("name", "candidate")

    pairs = met(marked).unionByName(met(rest)).distinct()
    found = pairs.withColumn("distance", F.levenshtein("name", "candidate", distance))
    return found.where("distance >= 0")
