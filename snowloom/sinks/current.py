"""Current tables kept up batch by batch: what a batch does not touch is neither read in full nor written again.

The rows of a current table lie in partitions by the version they have and by the merge that wrote them. A view
names the partitions that count, one for each version, so a merge writes new partitions beside the old ones
and then switches the view: readers see the table before or after it, never a part.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snowloom.functions import null_safe_equal
from snowloom.operators.versioning import latest
from snowloom.session import materialize
from snowloom.sinks.tables import Layout, append, drop_partitions, filled, insert

_GEN = "__gen"
_NONE = "none"


# The partitions that a table shows: of each version those of the merges that wrote rows of it.
Parts = dict[str, list[int]]


def rows_of(name: str) -> str:
    """The table that holds the rows behind a view."""
    return f"{name}__rows"


def live(spark: SparkSession, name: str) -> Parts:
    """The partitions that the table shows."""
    if not spark.catalog.tableExists(rows_of(name)):
        return {}
    return json.loads(spark.sql(f"SHOW TBLPROPERTIES {name} ('live')").first()["value"])


def _slot(version: str):
    return F.coalesce(F.col(version).cast("string"), F.lit(_NONE))


def _named(parts: Parts) -> list[str]:
    return sorted(f"{v}#{g}" for v, gens in parts.items() for g in gens)


def within(rows: DataFrame, version: str, parts: Parts) -> DataFrame:
    """The rows of the given partitions alone; the condition is on partition columns, so no other file is read."""
    return rows.where(F.concat_ws("#", _slot(version), _GEN).isin(_named(parts))).drop(_GEN)


def _stored(layout: Layout, version: str) -> Layout:
    return Layout((*[c for c in layout.partitions if c != version], version, _GEN), layout.buckets, layout.bucket_by, layout.format)


def write_part(rows: DataFrame, name: str, version: str, layout: Layout = Layout()) -> Parts:
    """Store rows under a number of their own, shown by no view yet; returns the partitions they fill."""
    spark, gen = rows.sparkSession, uuid.uuid4().int >> 65
    numbered = rows.withColumn(_GEN, F.lit(gen).cast("long"))
    if spark.catalog.tableExists(rows_of(name)):
        insert(numbered, rows_of(name), _stored(layout, version))
    else:
        append(numbered, rows_of(name), _stored(layout, version))
    return {v: [gen] for v in {_value(p, version) for p in filled(spark, rows_of(name), {_GEN: gen})}}


def _value(partition: str, version: str) -> str:
    value = dict(level.partition("=")[::2] for level in partition.split("/"))[version]
    return _NONE if value == "__HIVE_DEFAULT_PARTITION__" else unquote(value)


def _on(keys: Sequence[str], side: DataFrame) -> tuple[DataFrame, object]:
    renamed = side.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[c for c in side.columns if c not in keys])
    return renamed, null_safe_equal([(k, f"__k{i}") for i, k in enumerate(keys)])


def merge_part(
    batch: DataFrame,
    name: str,
    shown: Parts,
    keys: Sequence[str],
    version: str,
    ties: str = "one",
    tiebreak: Sequence[str] = (),
    layout: Layout = Layout(),
    history: DataFrame | None = None,
) -> Parts:
    """The partitions that a table shows after a merge, see ``merge``, from those it shows before; both stay."""
    spark = batch.sparkSession
    fresh = materialize(latest(batch, keys, version, ties, tiebreak), "merge-batch")
    if not shown:
        return write_part(fresh, name, version, layout)
    table = spark.table(rows_of(name))
    known = within(table, version, shown).select(*keys, version).distinct()
    versions = {r[0] for r in fresh.select(_slot(version)).distinct().collect()}
    lost = back = None
    if history is not None and versions & set(shown):
        # The batch, or another of its version, was here before: what it had then and has not now.
        again, same = _on([*keys, version], fresh.select(*keys, version).distinct())
        lost = known.where(_slot(version).isin(list(versions))).join(again, same, "left_anti").select(*keys)
        lost = materialize(lost.distinct(), "merge-lost")
        side, same = _on(keys, lost)
        theirs, own = _on(keys, fresh.select(*keys).distinct())
        back = latest(history.select(*fresh.columns).join(side, same, "left_semi"), keys, version, ties, tiebreak).join(theirs, own, "left_anti")
    # Of each key of the batch the version it has now.
    side, same = _on(keys, fresh.select(*keys).distinct())
    held = known.join(side, same, "left_semi").withColumnRenamed(version, "__held")
    side, same = _on(keys, held)
    newer = fresh.join(side, same, "left").where(F.col("__held").isNull() | (F.col(version) >= F.col("__held")))
    fresh = newer.select(*fresh.columns)
    gone = held.select(*keys, "__held").join(*_on(keys, fresh.select(*keys).distinct()), "left_semi")
    if lost is not None:
        fresh = fresh.unionByName(back)
        gone = gone.unionByName(known.join(*_on(keys, lost), "left_semi").withColumnRenamed(version, "__held"))
    fresh, gone = materialize(fresh, "merge-new"), materialize(gone, "merge-old")
    touched = {r[0] for r in fresh.select(_slot(version)).union(gone.select(_slot("__held"))).distinct().collect()}
    side, same = _on(keys, gone.select(*keys).distinct())
    rest = within(table, version, {v: g for v, g in shown.items() if v in touched}).join(side, same, "left_anti")
    written = write_part(fresh.unionByName(rest.select(*fresh.columns)), name, version, layout)
    return {v: g for v, g in shown.items() if v not in touched} | written


def merge(
    batch: DataFrame,
    name: str,
    keys: Sequence[str],
    version: str,
    ties: str = "one",
    tiebreak: Sequence[str] = (),
    layout: Layout = Layout(),
    history: DataFrame | None = None,
) -> list[str]:
    """Bring a current table up to date with a batch; returns the versions whose partitions were written.

    Afterwards the table has, of each key, the row (``ties="all"``: the rows) of the highest version among what it
    had and the batch, as ``versioning.latest`` over all batches would. A key's rows of a version are replaced as a whole, so a
    batch that comes again counts with its new rows. Keys that a repeated batch no longer has go back to their
    last version in ``history``, the rows of all batches with the new ones; it is read only for them.

    Read are the batch, keys and versions of the table, and the partitions in which a key of the batch has its rows
    now. Those partitions and the batch's own are written, under a number of this merge. ``layout`` gives further partitions,
    buckets and format; buckets by the keys let the table be searched for the batch's keys without moving it. For one
    writer a table; several tables change as one through ``Commit``.
    """
    spark = batch.sparkSession
    before = live(spark, name)
    if not before and spark.catalog.tableExists(name):
        # A table that has been kept in another way so far.
        batch = spark.table(name).select(*batch.columns).unionByName(batch)
    after = merge_part(batch, name, before, keys, version, ties, tiebreak, layout, history)
    columns = [c for c in spark.table(rows_of(name)).columns if c != _GEN]
    properties = f"'live' = '{json.dumps(after)}', 'before' = '{json.dumps(before)}'"
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({properties}) AS {select_parts(name, version, after, columns)}")
    return sorted({v for v in {*before, *after} if before.get(v) != after.get(v)})


def select_parts(name: str, version: str, parts: Parts, columns: Sequence[str]) -> str:
    """The text of a view that shows these partitions."""
    named = ", ".join(f"'{x}'" for x in _named(parts)) or "''"
    shown = ", ".join(f"`{c}`" for c in columns)
    return f"SELECT {shown} FROM {rows_of(name)} WHERE concat_ws('#', coalesce(CAST(`{version}` AS STRING), '{_NONE}'), {_GEN}) IN ({named})"


def drop_parts(spark: SparkSession, name: str, gens: Sequence[int]) -> int:
    """Drop the partitions written under these numbers; how many there were."""
    old = [p for g in sorted(set(gens)) for p in filled(spark, rows_of(name), {_GEN: g})]
    drop_partitions(spark, rows_of(name), old)
    return len(old)


def tidy(spark: SparkSession, name: str) -> int:
    """Drop the partitions that neither the table nor its state before the last merge shows; how many there were."""
    before = json.loads(spark.sql(f"SHOW TBLPROPERTIES {name} ('before')").first()["value"])
    used = {g for shown in (live(spark, name), before) for gens in shown.values() for g in gens}
    found = {int(r[0].rpartition("=")[2]) for r in spark.sql(f"SHOW PARTITIONS {rows_of(name)}").collect()}
    return drop_parts(spark, name, sorted(found - used))
