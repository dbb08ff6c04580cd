"""Mixing sources to target weights: capped water-filling, seeded whole and fractional repetitions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snowloom.llm.native import WORD, word_count
from snowloom.session import materialize

MAX_EPOCHS = 3
SEED = 42
# Hexadecimal digits of a document's draw that name its bucket; only one bucket per source is ordered.
BUCKET_DIGITS = 4


def cycling_weight(place: Column) -> Column:
    """1, 2, 3, 1, 2, 3, ... by the place of a source, counted from 0."""
    return place % 3 + 1


def draw(doc_id: Column, seed: int = SEED) -> Column:
    """The place of a document in its source's seeded order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def targets(
    sizes: DataFrame,
    weight: Callable[[Column], Column] = cycling_weight,
    max_epochs: int = MAX_EPOCHS,
    budget: Column | None = None,
) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row per source.

    The budget (all sizes together by default) is shared by weight. Where that exceeds ``max_epochs`` times
    a source's size the source is clamped there and the excess is shared anew among the others, until none
    is above. Sorted by the level at which a source is full, a source is clamped exactly if the level left
    by the fuller ones reaches its own, so no loop is needed. The windows run over one row per source.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.select(
        "source", "source_size", weight(F.row_number().over(by_name) - 1).cast("long").alias("weight"),
        (F.col("source_size") * max_epochs).alias("cap"),
    )
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    filled = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(whole) if budget is None else budget
    levels = weighed.select(
        "*", total.alias("total"),
        F.coalesce(F.sum("cap").over(filled.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("fuller"),
        F.sum("weight").over(filled.rowsBetween(0, W.unboundedFollowing)).alias("lighter"),
    ).withColumn("clamped", F.col("cap") * F.col("lighter") <= (F.col("total") - F.col("fuller")) * F.col("weight"))
    rest = F.col("total") - F.coalesce(F.sum(F.when(F.col("clamped"), F.col("cap"))).over(whole), F.lit(0))
    open_weight = F.sum(F.when(~F.col("clamped"), F.col("weight"))).over(whole)
    shared = levels.select("*", rest.alias("rest"), open_weight.alias("open_weight"))
    target = F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(
        (F.col("weight") * F.col("rest")).cast("double") / F.col("open_weight").cast("double")
    )
    return shared.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, size: Column | None = None, seed: int = SEED, **share) -> DataFrame:
    """``docs`` with its columns in ``row`` and beside them ``size, source_size, target, taken``.

    ``taken`` is the number of words the mix takes of a document: every document of a source as many whole
    times as the target allows, then documents in a seeded order until the target, rounded to words, is
    met; the last one counts in part. So the words of a source sum to its target within half a word, and
    no document is taken more than ``max_epochs`` times.

    A source is never ordered as a whole: the order is by a hash, sizes are summed per source and hash
    bucket, and only the bucket in which the target is met is sorted. A null text has size 0, a null
    source is a source of its own, repeated rows are drawn one after the other, an empty table gives none.
    """
    size = word_count(F.col("text")) if size is None else size
    rows = docs.select(
        F.struct("*").alias("row"), F.col("source").cast("string").alias("source"), size.alias("size"),
        draw(F.col("doc_id"), seed).alias("draw"),
    ).withColumn("bucket", F.substring("draw", 1, BUCKET_DIGITS))
    parts = materialize(rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")), "mix-buckets")
    goals = targets(parts.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), **share)
    words_ = F.round("target").cast("long")
    goals = goals.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(words_ / F.col("source_size"))).otherwise(0))
    goals = goals.withColumn("extra", words_ - F.col("whole") * F.col("source_size"))
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    running = parts.select("source", "bucket", "bucket_size", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("before"))
    met = running.withColumnRenamed("source", "s").join(goals, F.col("s").eqNullSafe(F.col("source")))
    met = met.where((F.col("before") <= F.col("extra")) & (F.col("extra") < F.col("before") + F.col("bucket_size")))
    edges = met.select(F.col("s"), F.col("bucket").alias("edge"), F.col("extra") - F.col("before"))
    edges = edges.toDF("s", "edge", "left_over")
    plan = goals.join(edges, F.col("source").eqNullSafe(F.col("s")), "left")
    # One row per source, written so that its size is known.
    plan = materialize(plan.select(F.col("source").alias("p"), "source_size", "target", "whole", "edge", "left_over"), "mix-plan")
    planned = rows.join(plan, F.col("source").eqNullSafe(F.col("p")))
    base, out = F.col("whole") * F.col("size"), ["row", "size", "source_size", "target"]
    inside = F.when(F.col("bucket") < F.col("edge"), F.col("size")).otherwise(0)
    clear = planned.where("edge is null or bucket <> edge").select(*out, (base + inside).cast("long").alias("taken"))
    ordered = W.partitionBy("source").orderBy("draw", "size").rowsBetween(W.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("size").over(ordered), F.lit(0))
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("left_over") - earlier))
    edge = planned.where("bucket = edge").select(*out, (base + part).cast("long").alias("taken"))
    return clear.unionByName(edge)


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row as often as taken, its columns unchanged. A repetition in part keeps the
    first words of the text with the white space between them. Documents not taken are left out; a
    document without words is kept once, as it takes nothing from any target."""
    size, taken = F.col("size"), F.col("taken")
    whole = F.when(size > 0, F.floor(taken / size)).otherwise(1).cast("int")
    part = F.when(size > 0, taken % size).otherwise(0).cast("int")
    runs = F.regexp_extract_all(F.col("row.text"), F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    cut = F.rtrim(F.array_join(F.slice(runs, F.lit(1), part), ""))
    copies = F.concat(
        F.array_repeat(F.col("row"), whole),
        F.when(part > 0, F.array(F.col("row").withField("text", cut))).otherwise(F.array().cast(mixed.select(F.array("row")).schema[0].dataType)),
    )
    return mixed.select(F.explode(copies).alias("row")).select("row.*")


SQL = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, source_size * {MAX_EPOCHS} AS cap FROM s),
l AS (
  SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fuller,
         sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lighter
  FROM w),
c AS (SELECT *, cap * lighter <= (total - fuller) * weight AS clamped FROM l),
r AS (
  SELECT *, total - coalesce(sum(cap) FILTER (clamped) OVER (), 0) AS rest, sum(weight) FILTER (NOT clamped) OVER () AS open_weight
  FROM c),
t AS (
  SELECT source, source_size,
         CASE WHEN clamped THEN CAST(cap AS DOUBLE) ELSE CAST(weight * rest AS DOUBLE) / CAST(open_weight AS DOUBLE) END AS target
  FROM r),
g AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(round(target) / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
o AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.whole, CAST(round(g.target) AS BIGINT) - g.whole * g.source_size AS extra,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY draw, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + greatest(0, least(size, extra - before)) AS BIGINT) AS taken FROM o
"""
