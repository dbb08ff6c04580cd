"""Joins on keys of which a few may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowloom.functions import null_safe_equal, row_hash

# A key is heavy when it holds more than this share of the rows, so there are at most 1 / share such
# keys whatever the size of the data. That is the bound that allows broadcasting them.
HEAVY_SHARE = 0.001


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float = HEAVY_SHARE, weight: str | None = None) -> DataFrame:
    """The keys holding more than ``share`` of the rows (fewer than ``1 / share`` of them).

    A row counts as often as ``weight`` says.
    """
    counted = df.groupBy(*keys).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("__n"))
    total = counted.agg(F.sum("__n")).scalar()
    return counted.where(F.col("__n") > total * share).drop("__n")


def heavy_copies(df: DataFrame, share: float = HEAVY_SHARE) -> list[int]:
    """The hashes of rows of which exact copies hold more than ``share`` of all rows.

    Found by one pass with a bounded sketch and no shuffle. The sketch tracks more values than there can be
    such rows, and never counts too few, so none is missed; there are fewer than ``1 / share``.
    """
    tracked = int(8 / share)
    counted = df.select(row_hash(df).alias("h")).agg(
        F.call_function("approx_top_k", F.col("h"), F.lit(int(1 / share)), F.lit(tracked)).alias("top"), F.count(F.lit(1)).alias("n")
    )
    found = counted.first()
    return [] if not found.n else [r["item"] for r in found.top if r["count"] > max(1, found.n * share)]


def collapsed(df: DataFrame, share: float = HEAVY_SHARE) -> DataFrame | None:
    """``df`` with ``__copies``: rows with very many exact copies once, with their number, all others with 1.

    Nothing tells copies apart, so no hash of a row can spread them. None if no row has so many.
    """
    heavy = heavy_copies(df, share)
    if not heavy:
        return None
    is_heavy = row_hash(df).isin(heavy)
    merged = df.where(is_heavy).groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__copies"))
    return df.where(~is_heavy).withColumn("__copies", F.lit(1).cast("long")).unionByName(merged)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "left",
    salts: int = 64,
    share: float = HEAVY_SHARE,
) -> DataFrame:
    """Join a side with heavy keys to a side that has few rows per key.

    Rows of a heavy key are spread over ``salts`` tasks and the matching right rows are repeated as
    often. All other rows are neither spread nor repeated. The result is that of the plain join. Rows that are
    exact copies are spread in counted portions, as their hash is one; a job finds them when this is called.
    Meant for joins that the adaptive skew split cannot take, or where its size threshold is too late.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot repeat the right side of a {how} join")
    left_keys, cols = [a for a, _ in on], left.columns
    merged = collapsed(left, share)
    hash_ = row_hash(left)
    if merged is not None:
        # Copies of a row go in as many portions as there are salts.
        portion = F.col("__portion").cast("long")
        copies = F.floor((F.col("__copies") + salts - 1 - portion) / salts)
        left = merged.select("*", F.explode(F.sequence(F.lit(0), F.least(F.col("__copies"), F.lit(salts)).cast("int") - 1)).alias("__portion"))
        left = left.select(*cols, copies.cast("int").alias("__copies"), (hash_ + portion).alias("__hash"))
    else:
        left = left.select(*cols, F.lit(1).alias("__copies"), hash_.alias("__hash"))
    heavy = F.broadcast(
        heavy_keys(left, left_keys, share, "__copies").select(
            *[F.col(k).alias(f"__h{i}") for i, k in enumerate(left_keys)], F.lit(True).alias("__heavy")
        )
    )
    spread = (
        left.join(heavy, null_safe_equal([(k, f"__h{i}") for i, k in enumerate(left_keys)]), "left")
        .withColumn("__salt", F.when(F.col("__heavy"), F.pmod("__hash", F.lit(salts))).otherwise(F.lit(0).cast("long")))
        .select(*cols, "__copies", "__salt")
    )
    repeated = (
        right.join(heavy, null_safe_equal([(k, f"__h{i}") for i, (_, k) in enumerate(on)]), "left")
        .withColumn(
            "__rsalt",
            F.explode(
                F.when(F.col("__heavy"), F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).otherwise(
                    F.array(F.lit(0).cast("long"))
                )
            ),
        )
        .select(*right.columns, "__rsalt")
    )
    condition = F.col("__salt") == F.col("__rsalt")
    for a, b in on:
        condition = condition & (F.col(a) == F.col(b))
    joined = spread.join(repeated, condition, how).drop("__salt", "__rsalt")
    if merged is not None:
        joined = joined.withColumn("__copies", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return joined.drop("__copies")
