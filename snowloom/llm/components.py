"""Connected components of a graph given by its links, without bringing the graph anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowloom.session import materialize


def _large_star(links: DataFrame) -> DataFrame:
    """Every node tells its larger neighbours about the smallest node it knows."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    told = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return told.where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours link to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node that has a link; ``root`` is the smallest node reachable.

    ``links`` has two columns of one orderable type; direction, repeats and loops do not matter. The two
    steps alternate until every node links to its root. Each round is written to the shared folder, so a
    lost executor costs one round's task at most; the driver sees a count and a checksum per round. A
    node of very many links is counted by partial aggregation and joined by splittable joins.
    """
    a, b = links.columns
    start = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    links, seen = materialize(start, "links"), None
    while True:
        mark = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen or not mark[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = mark
        links = materialize(_small_star(_large_star(links)), "links")
