"""History, latest versions, upserts and guarded appends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snowloom.functions import null_safe_equal, row_hash
from snowloom.session import materialize


def latest(
    df: DataFrame, keys: Sequence[str], version: str, ties: str = "one", tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The rows of the highest version of each key. A null version is the lowest.

    ``ties="one"`` keeps one row per key, the one with the highest ``tiebreak``. Because only the first
    row is kept, Spark drops the others in each task before the shuffle, however heavy the key.
    ``ties="all"`` keeps every row of the highest version, which may be a large share of all rows;
    those are found by joining to the highest version of each key, because a window would bring all
    of them to one task.
    """
    if ties == "one":
        order = [F.col(version).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tiebreak], row_hash(df).desc()]
        number = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
        return df.withColumn("__number", number).where("__number = 1").drop("__number")
    if ties != "all":
        raise ValueError("ties is 'one' or 'all'")
    top = df.groupBy(*keys).agg(F.max(version).alias("__top"))
    top = top.select(F.col("__top"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    same = null_safe_equal([*[(k, f"__k{i}") for i, k in enumerate(keys)], (version, "__top")])
    return df.join(top, same, "left_semi")


def upsert_latest(
    prev: DataFrame | None,
    new: DataFrame,
    keys: Sequence[str],
    version: str,
    tiebreak: Sequence[str] = (),
    ties: str = "one",
) -> DataFrame:
    """Previous and new rows together, of each key the row (or rows, see ``latest``) of the highest version."""
    rows = new if prev is None else prev.unionByName(new, allowMissingColumns=True)
    return latest(rows, keys, version, ties, tiebreak)


def append_guarded(prev: DataFrame | None, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The new rows whose key is not there yet, so that loading a batch again adds nothing."""
    if prev is None:
        return new
    seen = prev.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).distinct()
    return new.join(seen, null_safe_equal([(k, f"__k{i}") for i, k in enumerate(keys)]), "left_anti")


def only_keys(df: DataFrame, touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key is among the touched ones. The touched keys are written, so that Spark knows
    their size and need not shuffle the rows when they are few."""
    wanted = touched.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).distinct()
    wanted = materialize(wanted, "touched-keys")
    return df.join(wanted, null_safe_equal([(k, f"__k{i}") for i, k in enumerate(keys)]), "left_semi")


def replace_keys(prev: DataFrame | None, rebuilt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Previous rows with those of the rebuilt keys exchanged. The rebuilt rows are written first, as
    they are read for their keys and for themselves."""
    if prev is None:
        return rebuilt
    rebuilt = materialize(rebuilt, "rebuilt")
    return append_guarded(rebuilt, prev, keys).unionByName(rebuilt)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames by column name; a column a frame lacks is null there."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
