"""Writing tables: layouts, dynamic partitions, landing of batches, versions behind a view."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snowloom.session import materialize, setting


@dataclass(frozen=True)
class Layout:
    """Partition columns and buckets of a table, fixed once: Spark refuses another layout on append."""

    partitions: Sequence[str] = ()
    buckets: int = 0
    bucket_by: Sequence[str] = ()
    format: str = "orc"


def stamp(df: DataFrame, batch_date: date | str | None = None, column: str = "upd_date") -> DataFrame:
    """Add the load date: the given batch date, or today's."""
    value = F.current_date() if batch_date is None else F.lit(str(batch_date)).cast("date")
    return df.withColumn(column, value)


def partitions_last(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in partitions], *partitions)


def gathered(df: DataFrame, layout: Layout, constant: Sequence[str] = ()) -> DataFrame:
    """Bring rows of one partition and bucket together before a write, so files are few and full.

    A rebalance, not a repartition: Spark measures the result, splits what is too large, so a
    partition holding a third of the rows is written by many tasks, and merges what is too small.
    Partition columns that are ``constant`` in these rows bring nothing together; without others and
    without buckets the rows are written where they are.
    """
    by = [c for c in layout.partitions if c not in constant]
    if not by and not layout.buckets:
        return df
    if layout.buckets:
        # The number Spark's own bucketing gives the row.
        df = df.withColumn("__bucket", F.pmod(F.hash(*layout.bucket_by), F.lit(layout.buckets)))
        by.append("__bucket")
    return df.hint("rebalance", *by).drop("__bucket")


def create_table(
    df: DataFrame, table: str, layout: Layout = Layout(), mode: str = "overwrite", constant: Sequence[str] = ()
) -> None:
    """Write a table that has the layout; ``overwrite`` replaces the whole table."""
    df = partitions_last(df, layout.partitions)
    writer = gathered(df, layout, constant).write.format(layout.format).mode(mode)
    if layout.partitions:
        writer = writer.partitionBy(*layout.partitions)
    if layout.buckets:
        writer = writer.bucketBy(layout.buckets, *layout.bucket_by).sortBy(*layout.bucket_by)
    writer.saveAsTable(table)


def append(df: DataFrame, table: str, layout: Layout = Layout()) -> None:
    """Add rows, creating the table when it is not there."""
    if df.sparkSession.catalog.tableExists(table):
        insert(df, table, layout)
    else:
        create_table(df, table, layout)


def insert(
    df: DataFrame, table: str, layout: Layout = Layout(), overwrite: bool = False, constant: Sequence[str] = ()
) -> None:
    """Insert by column name; with ``overwrite`` the partitions the rows fall in are replaced."""
    spark = df.sparkSession
    rows = gathered(df.select(*spark.table(table).columns), layout, constant)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        rows.write.insertInto(table, overwrite=overwrite)


def filled(spark: SparkSession, table: str, where: Mapping[str, object]) -> list[str]:
    """The partitions of a table with these values, as the catalog lists them; no file is read."""
    return [row[0] for row in spark.sql(f"SHOW PARTITIONS {table} PARTITION ({_spec(where)})").collect()]


def _spec(values: Mapping[str, object]) -> str:
    return ", ".join(f"`{c}` = " + ("NULL" if v is None else "'" + str(v).replace("'", "\\'") + "'") for c, v in values.items())


def drop_partitions(spark: SparkSession, table: str, partitions: Sequence[str]) -> None:
    """Drop partitions, named as the catalog lists them."""
    for i in range(0, len(partitions), 100):
        parts = [[level.partition("=")[::2] for level in p.split("/")] for p in partitions[i : i + 100]]
        specs = [_spec({c: None if v == _NULL_PARTITION else unquote(v) for c, v in levels}) for levels in parts]
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({x})" for x in specs))


_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def replace_slice(df: DataFrame, table: str, layout: Layout, where: Mapping[str, object]) -> None:
    """Store rows that all have the values of ``where`` in place of those stored with them.

    ``where`` names some of the table's partition columns, say a batch's date. An insert replaces the partitions
    that the new rows fall in; the catalog knows which others the values had before, and those are dropped
    after it. So a batch that comes again leaves nothing behind where it no longer has rows, also if it is
    empty, and a run that ended in between is put right by the next one. Only values met before cost
    anything more than an insert: one look at the partition columns of the new rows.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        create_table(df, table, layout, constant=list(where))
        return
    before = filled(spark, table, where)
    insert(df, table, layout, overwrite=True, constant=list(where))
    rest = [c for c in layout.partitions if c not in where]
    if not before:
        return
    if rest:
        # As many rows as one batch fills partitions.
        now = {tuple(row) for row in df.select(*[F.col(c).cast("string") for c in rest]).distinct().collect()}
    else:
        now = set() if df.isEmpty() else {()}

    def values(partition: str) -> tuple:
        held = {c: None if v == _NULL_PARTITION else unquote(v) for c, v in (x.partition("=")[::2] for x in partition.split("/"))}
        return tuple(held[c] for c in rest)

    drop_partitions(spark, table, [p for p in before if values(p) not in now])


def land(
    df: DataFrame,
    table: str,
    batch_date: date | str | None = None,
    layout: Layout = Layout(("upd_date",)),
    landing: int | None = None,
    index: Sequence[str] = (),
) -> None:
    """Store a batch as the partition of its date. Landing the same batch again replaces it.

    Partitions are the date alone, or the date and ``landing``: then several landings of one date stay side by
    side, and one is replaced only under its own number. Every landing is noted under a number, which is drawn
    unless the caller has one that a repeat will have too. Numbers have no order and no clock gives them, so
    a date landed again is a new batch to its readers, whichever machine lands it.
    With ``index``, the batch's different keys in these columns are noted too, see ``holding``.
    """
    if list(layout.partitions) not in (["upd_date"], ["upd_date", "landing"]):
        raise ValueError("a landing table is partitioned by its load date, or by that and the landing")
    spark, number = df.sparkSession, uuid.uuid4().int >> 65 if landing is None else landing
    rows = stamp(df, batch_date)
    if "landing" in layout.partitions:
        rows = rows.withColumn("landing", F.lit(number).cast("long"))
    if spark.catalog.tableExists(table):
        if landing is not None and "landing" in layout.partitions:
            # A repeat on another day leaves no second copy.
            drop_partitions(spark, table, filled(spark, table, {"landing": number}))
        insert(rows, table, layout, overwrite=True, constant=layout.partitions)
    else:
        create_table(rows, table, layout, constant=layout.partitions)
    if index:
        _note_keys(spark, table, batch_date, number if "landing" in layout.partitions else None, index)
    # Noted after the rows are there: a reader of the note finds them.
    noted = spark.range(1).select(F.lit(number).cast("long").alias("landing"))
    append(stamp(noted, batch_date), _landings(table))


def _landings(table: str) -> str:
    return f"{table}__landings"


def _keys_of(table: str) -> str:
    return f"{table}__keys"


def _note_keys(spark: SparkSession, table: str, batch_date: date | str | None, landing: int | None, index: Sequence[str]) -> None:
    """Write the different keys of the partition just landed. Its rows are read from the table, these columns alone."""
    day = F.current_date() if batch_date is None else F.lit(str(batch_date)).cast("date")
    rows = spark.table(table).where(F.col("upd_date") == day)
    if landing is not None:
        rows = rows.where(F.col("landing") == landing)
    parts = ["upd_date"] + (["landing"] if landing is not None else [])
    layout = Layout(tuple(parts), 16, tuple(index))
    keys = materialize(rows.select(*index, *parts).distinct(), "landed-keys")
    if spark.catalog.tableExists(_keys_of(table)):
        where = {} if landing is None else {"landing": landing}
        if batch_date is not None:
            where["upd_date"] = batch_date
        if where:
            drop_partitions(spark, _keys_of(table), filled(spark, _keys_of(table), where))
        insert(keys, _keys_of(table), layout, overwrite=True, constant=parts)
    else:
        create_table(keys, _keys_of(table), layout, constant=parts)


def holding(spark: SparkSession, table: str, wanted: DataFrame, keys: Sequence[str], within: DataFrame) -> DataFrame:
    """Those batches of ``within`` (``upd_date``, maybe ``landing``) that hold any of the wanted keys.

    Answered from the keys noted at landing, one narrow row for each key of a batch, so no batch is read for it. A
    table landed without an index, or with another, gives all of ``within``.
    """
    name = _keys_of(table)
    if not spark.catalog.tableExists(name) or not set(keys) <= set(spark.table(name).columns):
        return within
    spark.catalog.refreshTable(name)
    noted = spark.table(name)
    parts = [c for c in ("upd_date", "landing") if c in noted.columns and c in within.columns]
    some = noted.join(wanted.select(*keys).distinct(), list(keys), "left_semi").select(*parts).distinct()
    # Batches that landed before there was an index are not told apart.
    unknown = within.join(noted.select(*parts).distinct(), parts, "left_anti")
    return within.join(some, parts, "left_semi").unionByName(unknown)


def pin(spark: SparkSession, table: str, marks: str) -> DataFrame:
    """``(upd_date, landing)``: the landings of a table that no run has consumed, as they are now.

    Whatever its date, a batch is pending until it is marked itself: one that is older than the newest
    consumed, and one whose date was consumed and has been landed again since. The answer is written, so
    all reads of a run see the same batches; one that lands meanwhile waits for the next run. A table that
    nothing has landed in has none.
    """
    seen = spark.table(marks).where(F.col("source") == table) if spark.catalog.tableExists(marks) else None
    return unconsumed(spark, table, seen)


def unconsumed(spark: SparkSession, table: str, seen: DataFrame | None) -> DataFrame:
    """The landings of a table that are not among those seen, which have a ``landing``; see ``pin``."""
    if not spark.catalog.tableExists(_landings(table)):
        return spark.createDataFrame([], "upd_date date, landing long")
    # Other sessions land too, and this one may remember which files a table had.
    spark.catalog.refreshTable(_landings(table))
    log = spark.table(_landings(table)).distinct()
    if seen is not None:
        # A landing repeated on another day keeps its number, and is the same one.
        log = log.join(seen.select("landing").distinct(), "landing", "left_anti").select("upd_date", "landing")
    return materialize(log, "pinned-batches")


def batches(spark: SparkSession, table: str, pinned: DataFrame) -> DataFrame:
    """The rows of the given batches. Their partitions are named in the plan, so others are not even listed as files.

    The batches are brought to the driver: a row for each landing, as many as the table has partitions.
    """
    spark.catalog.refreshTable(table)
    rows = spark.table(table)
    parts = [c for c in ("upd_date", "landing") if c in rows.columns and c in pinned.columns]
    if not {"upd_date"} <= set(parts):
        raise ValueError("batches have a load date")
    found = sorted({tuple(r) for r in pinned.select(*parts).collect()}, key=str)
    days = rows.where(F.col("upd_date").isin([r[0] for r in found]))
    return days.where(F.col("landing").isin([r[1] for r in found])) if len(parts) > 1 else days


def pending(spark: SparkSession, table: str, marks: str) -> DataFrame:
    """The rows of the batches that no run has consumed yet."""
    return batches(spark, table, pin(spark, table, marks))


def consumed(spark: SparkSession, table: str, marks: str) -> DataFrame:
    """The dates of a landing table of which some landing has been consumed."""
    none = spark.createDataFrame([], "upd_date date")
    if not spark.catalog.tableExists(marks):
        return none
    return spark.table(marks).where(F.col("source") == table).select("upd_date").distinct()


def mark_consumed(pinned: DataFrame, table: str, marks: str) -> None:
    """Note exactly the pinned batches as consumed, once the run that read them has succeeded."""
    append(pinned.select(F.lit(table).alias("source"), "upd_date", "landing"), marks)


def publish(df: DataFrame, name: str, layout: Layout = Layout()) -> str:
    """Replace a table that ``df`` may itself read: write a new version, then point the view at it.

    Readers see the old version or the new one, never a part. The view carries the name of the version it
    shows. Old versions stay until ``retire``, as does one whose run ended before the view was switched.
    """
    version = new_version(df, name, layout)
    show_version(df.sparkSession, name, version)
    return version


def new_version(df: DataFrame, name: str, layout: Layout = Layout()) -> str:
    """Write a version of a table that no view shows yet. Version names sort in the order they were made."""
    version = f"{name}__v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    create_table(df, version, layout)
    return version


def show_version(spark: SparkSession, name: str, version: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_SHOWN}' = '{version}') AS SELECT * FROM {version}")


_SHOWN = "shown_version"


def shown(spark: SparkSession, name: str) -> str:
    """The version that a published table shows."""
    return spark.sql(f"SHOW TBLPROPERTIES {name} ('{_SHOWN}')").first()["value"]


def extend(df: DataFrame, name: str, layout: Layout = Layout()) -> None:
    """Add rows to the version a published table shows, without writing the others again."""
    insert(df, shown(df.sparkSession, name), layout)


def versions(spark: SparkSession, name: str) -> list[str]:
    """The stored versions of a published table, oldest first, unfinished ones included."""
    database, _, table = name.rpartition(".")
    found = spark.catalog.listTables(database or None, f"{table}__v*")
    return sorted(f"{database}.{t.name}" if database else t.name for t in found)


def retire(spark: SparkSession, name: str, keep: int = 2) -> None:
    """Keep the version the view shows and the ``keep - 1`` before it; drop older and unfinished ones.

    For the one writer of a table: a version that another writer has not yet shown would be dropped too.
    """
    if keep < 1:
        raise ValueError("the shown version is in use")
    stored = versions(spark, name)
    at = stored.index(shown(spark, name))
    for version in [*stored[: max(0, at - keep + 1)], *stored[at + 1 :]]:
        spark.sql(f"DROP TABLE {version}")


def copy_tables(spark: SparkSession, names: Mapping[str, str], layouts: Mapping[str, Layout] | None = None) -> None:
    """Copy tables, each into the layout given for its target."""
    for source, target in names.items():
        create_table(spark.table(source), target, (layouts or {}).get(target, Layout()))


def ensure_database(spark: SparkSession, name: str, location: str | None = None, reset: bool = False) -> None:
    """Create a database if it is not there; ``reset`` drops it with all its tables first."""
    if reset:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{at}")
