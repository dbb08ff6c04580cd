"""Surrogate ids: dense, in a stated order, and stable over loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snowloom.functions import null_safe_equal, row_hash
from snowloom.functions.columns import as_column
from snowloom.operators.skew import collapsed
from snowloom.session import materialize

# monotonically_increasing_id keeps the partition in its upper bits and the row position in these.
_POSITION_BITS = 33
# Copies of one row numbered by one task.
_PORTION = 100_000


def dense_id(
    df: DataFrame,
    order: Sequence[str | Column],
    id_column: str,
    start: int | Column = 0,
    partitions: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Number all rows ``start, start + 1, ...`` in the given order, without a global window.

    Rows are cut into sorted ranges, each row notes its range and its position in it, and the ranges
    are written once. Range sizes, one row per range, then give every range its first number. Writing
    matters: sampled range bounds may differ between two runs of one plan, written ranges do not.
    A hash of the row completes the order, so rows that tie on ``order`` may still fall in different
    ranges. Exact copies that hold a large share of all rows cannot be cut by any order; they go through the
    ranges as one row with a number and are counted out afterwards, in portions of ``_PORTION``.

    Jobs run when this is called: one pass looks for such copies, one samples the ranges, one writes them. The rows
    are written before the first, so that what they come from is computed once; ``stored`` ones are already.
    """
    if not stored:
        df = materialize(df, "unnumbered")
    tie, place, part, pos, copies = "__tie", "__place", "__part", "__pos", "__copies"
    order = [as_column(c) for c in order]
    merged = collapsed(df)
    hashed = (df.withColumn(copies, F.lit(1).cast("long")) if merged is None else merged).withColumn(tie, row_hash(df))
    by = [*order, F.col(tie)]
    ranged = hashed.repartitionByRange(partitions, *by) if partitions else hashed.repartitionByRange(*by)
    placed = (
        ranged.sortWithinPartitions(*by)
        .withColumn(place, F.monotonically_increasing_id())
        .select(
            *df.columns,
            copies,
            F.shiftright(place, _POSITION_BITS).alias(part),
            F.col(place).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias(pos),
        )
    )
    written = materialize(placed, "dense-id")
    # Within a range, a row's number is its position and the further copies of rows before it.
    more = F.filter(F.collect_list(F.when(F.col(copies) > 1, F.struct(pos, copies))), lambda x: x.isNotNull())
    sizes = written.groupBy(part).agg(F.sum(copies).alias("__size"), more.alias("__more"))
    # One row per range here, never one per row of the data.
    before = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    firsts = sizes.select(F.col(part), F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__first"), "__more")
    first = start if isinstance(start, Column) else F.lit(start)
    further = F.aggregate(
        "__more", F.lit(0).cast("long"), lambda n, x: n + F.when(x[pos] < F.col(pos), x[copies] - 1).otherwise(0)
    )
    number = (F.col("__first") + F.col(pos) + further + first).cast("long").alias(id_column)
    numbered = written.join(F.broadcast(firsts), part).select(number, *df.columns, copies)
    if merged is None:
        return numbered.drop(copies)
    # Portions are spread before they are counted out.
    portions = F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1, F.lit(_PORTION).cast("long"))).alias("__from")
    cut = numbered.where(F.col(copies) > 1).select("*", portions).repartition(id_column, "__from")
    last = F.least(F.col(copies), F.col("__from") + _PORTION) - 1
    counted = cut.withColumn("__at", F.explode(F.sequence(F.col("__from"), last)))
    counted = counted.select((F.col(id_column) + F.col("__at")).alias(id_column), *df.columns)
    return numbered.where(F.col(copies) == 1).drop(copies).unionByName(counted)


def next_id(df: DataFrame, id_column: str) -> Column:
    """One more than the highest id, as a scalar subquery; 0 for an empty frame."""
    return F.coalesce(df.agg(F.max(id_column)).scalar() + 1, F.lit(0)).cast("long")


def stable_ids(
    entities: DataFrame,
    known: DataFrame | None,
    keys: Sequence[str],
    id_column: str,
    order: Sequence[str | Column] | None = None,
    start: int | Column = 0,
) -> DataFrame:
    """Give every entity an id: the one it had in ``known``, else the next free one.

    ``entities`` has one row per key, ``known`` any number of rows with the keys and the id. A null in
    a key counts as a value. Without ``known`` the numbering begins at ``start``. Jobs run when this is called.
    """
    order = list(order or keys)
    if known is None:
        return dense_id(entities, order, id_column, start)
    held = known.groupBy(*keys).agg(F.min(id_column).alias("__held"))
    held = held.select(F.col("__held"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    matched = entities.join(held, null_safe_equal([(k, f"__k{i}") for i, k in enumerate(keys)]), "left").select(
        F.col("__held").alias(id_column), *entities.columns
    )
    # Read three times below, so it is computed once.
    matched = materialize(matched, "matched-ids")
    old = matched.where(F.col(id_column).isNotNull())
    new = matched.where(F.col(id_column).isNull()).drop(id_column)
    return old.unionByName(dense_id(new, order, id_column, next_id(known, id_column), stored=True))


def attach_ids(df: DataFrame, ids: DataFrame, keys: Sequence[str], id_column: str) -> DataFrame:
    """Join ids back to rows by key; a null in a key matches a null."""
    right = ids.select(F.col(id_column), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    joined = df.join(right, null_safe_equal([(k, f"__k{i}") for i, k in enumerate(keys)]), "left")
    return joined.select(F.col(id_column), *df.columns)
