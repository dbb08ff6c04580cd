"""One commit for many tables: a run's new state of all its tables becomes the database's state at once, or not at all.

Every table is stored so that an old state stays readable beside a new one: as versions (``publish``), or as partitions
numbered by what wrote them (``merge``, ``put``, ``add``). A commit is a small file that names the state of every
table. Its number is the one after the commit that the run began from, and the file is created only if there is none
of that number: of two runs that began alike one commits, the other is told so and has changed nothing. A run that dies
leaves no commit, so nobody sees any of its rows. Views by the tables' names are pointed at the new state behind the
commit; who must not see one table ahead of another reads through ``Commit.frame``.

The file system must create a file exclusively, as HDFS does.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snowloom.sinks import current, tables
from snowloom.sinks.tables import Layout


class Conflict(RuntimeError):
    """Another run has committed since this one began."""


def _folder(spark: SparkSession, database: str):
    location = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE DATABASE {database}").collect()}["Location"]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{location}/_commits")
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _read(spark: SparkSession, fs, path) -> dict[str, Any] | None:
    """The content of a commit; null while, or if for ever, it is not complete."""
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text) if text.endswith("}\n") else None


def commits(spark: SparkSession, database: str) -> list[int]:
    """The numbers taken, lowest first, those of unfinished commits included."""
    folder, fs = _folder(spark, database)
    if not fs.exists(folder):
        return []
    return sorted(int(f.getPath().getName().removesuffix(".json")) for f in fs.listStatus(folder) if f.getPath().getName().endswith(".json"))


def state(spark: SparkSession, database: str, number: int) -> dict[str, Any] | None:
    """What a commit names of each table; null if it is unfinished."""
    folder, fs = _folder(spark, database)
    return _read(spark, fs, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, f"{number:010d}.json"))


def abandon(spark: SparkSession, database: str, number: int) -> None:
    """Free the number of a commit whose writer died while it wrote the file."""
    if state(spark, database, number) is not None:
        raise ValueError("the commit is complete")
    folder, fs = _folder(spark, database)
    fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, f"{number:010d}.json"), False)


class Commit:
    """The tables of a database as one run sees and changes them.

    It begins from the newest commit and sees no later one. ``frame`` gives a table with the run's own changes.
    """

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database
        taken = commits(spark, database)
        self.number = taken[-1] if taken else 0
        self.base: dict[str, Any] = {}
        if taken:
            found = state(spark, database, self.number)
            if found is None:
                raise Conflict(f"commit {self.number} of {database} is being written, or its writer died: see abandon")
            self.base = found
        self.changes: dict[str, Any] = {}

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def known(self, table: str) -> dict[str, Any] | None:
        return self.changes.get(table) or self.base.get(table)

    def frame(self, table: str) -> DataFrame | None:
        """A table as this run sees it; null if there is none."""
        known = self.known(table)
        if known is None:
            return None
        if known["kind"] == "view":
            return self.frame(known["of"]).select(*known["columns"])
        if known["kind"] == "version":
            return self.spark.table(known["table"])
        return current.within(self.spark.table(current.rows_of(self.name(table))), known["version"], known["parts"]).select(*known["columns"])

    def publish(self, table: str, df: DataFrame, layout: Layout = Layout()) -> None:
        """A new version of a whole table, which ``df`` may itself read."""
        self.changes[table] = {"kind": "version", "table": tables.new_version(df, self.name(table), layout)}

    def _parts(self, table: str, version: str) -> current.Parts:
        known = self.known(table)
        if known is not None and (known["kind"], known.get("version")) != ("parts", version):
            raise ValueError(f"{table} is not kept in parts by {version}")
        return {} if known is None else known["parts"]

    def _set(self, table: str, df: DataFrame, version: str, parts: current.Parts) -> None:
        self.changes[table] = {"kind": "parts", "version": version, "parts": parts, "columns": df.columns}

    def merge(self, table: str, batch: DataFrame, keys: Sequence[str], version: str, **options) -> None:
        """Bring a current table up to date with a batch; see ``current.merge``."""
        before = self._parts(table, version)
        self._set(table, batch, version, current.merge_part(batch, self.name(table), before, keys, version, **options))

    def put(self, table: str, df: DataFrame, version: str, value: object, layout: Layout = Layout()) -> None:
        """Rows that all have this value in the version column, in place of all that the table has with it."""
        rest = {v: g for v, g in self._parts(table, version).items() if v != str(value)}
        self._set(table, df, version, rest | current.write_part(df, self.name(table), version, layout))

    def add(self, table: str, df: DataFrame, version: str, layout: Layout = Layout()) -> None:
        """Further rows."""
        parts = {v: list(g) for v, g in self._parts(table, version).items()}
        for v, gens in current.write_part(df, self.name(table), version, layout).items():
            parts[v] = parts.get(v, []) + gens
        self._set(table, df, version, parts)

    def view(self, table: str, columns: Sequence[str], of: str) -> None:
        """Some columns of a table under a name of their own."""
        self.changes[table] = {"kind": "view", "of": of, "columns": list(columns)}

    def commit(self) -> int:
        """Make the changes the database's state; returns the commit's number. Without changes there is none."""
        if not self.changes:
            return self.number
        taken = commits(self.spark, self.database)
        if (taken[-1] if taken else 0) != self.number:
            raise Conflict(f"{self.database} has gone on from commit {self.number} to {taken[-1]}")
        folder, fs = _folder(self.spark, self.database)
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder, f"{self.number + 1:010d}.json")
        try:
            out = fs.create(path, False)
        except Exception as error:  # py4j wraps whatever the file system throws
            if fs.exists(path):
                raise Conflict(f"another run has made commit {self.number + 1} of {self.database}") from error
            raise
        out.write(bytearray((json.dumps(self.base | self.changes) + "\n").encode()))
        out.close()
        self.base, self.number = self.base | self.changes, self.number + 1
        shown, self.changes = self.changes, {}
        self.show(shown)
        return self.number

    def show(self, names: Sequence[str] | None = None) -> None:
        """Point the views at this state. A run that died behind its commit has not; the next one does."""
        def after(table: str) -> bool:
            return self.base[table]["kind"] == "view"

        for table in sorted(names if names is not None else self.base, key=after):
            known = self.base[table]
            if known["kind"] == "version":
                tables.show_version(self.spark, self.name(table), known["table"])
                continue
            if known["kind"] == "view":
                text = f"SELECT {', '.join(f'`{c}`' for c in known['columns'])} FROM {self.name(known['of'])}"
            else:
                text = current.select_parts(self.name(table), known["version"], known["parts"], known["columns"])
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(table)} AS {text}")

    def tidy(self) -> None:
        """Drop what the commit two before this one showed and the last two do not. What no commit has named may be
        another run's work and stays; see ``sweep``."""
        taken = [n for n in commits(self.spark, self.database) if n <= self.number]
        if len(taken) < 3:
            return
        old, *new = (state(self.spark, self.database, n) or {} for n in taken[-3:])
        self._drop(old, new)

    def _drop(self, old: dict[str, Any], new: Sequence[dict[str, Any]]) -> None:
        for table, known in old.items():
            kept = [s[table] for s in new if table in s]
            if known["kind"] == "version" and known["table"] not in {k.get("table") for k in kept}:
                self.spark.sql(f"DROP TABLE IF EXISTS {known['table']}")
            elif known["kind"] == "parts":
                used = {g for k in kept if k["kind"] == "parts" for gens in k["parts"].values() for g in gens}
                current.drop_parts(self.spark, self.name(table), [g for gens in known["parts"].values() for g in gens if g not in used])

    def sweep(self) -> None:
        """Drop all that the last two commits do not name, also what dead runs left. Only while no other run works."""
        kept = [state(self.spark, self.database, n) or {} for n in commits(self.spark, self.database)[-2:]]
        for table, known in self.base.items():
            if known["kind"] == "version":
                named = {s[table].get("table") for s in kept if table in s}
                for version in tables.versions(self.spark, self.name(table)):
                    if version not in named:
                        self.spark.sql(f"DROP TABLE {version}")
            elif known["kind"] == "parts":
                used = {g for s in kept if s.get(table, {}).get("kind") == "parts" for gens in s[table]["parts"].values() for g in gens}
                rows = self.spark.sql(f"SHOW PARTITIONS {current.rows_of(self.name(table))}").collect()
                current.drop_parts(self.spark, self.name(table), sorted({int(r[0].rpartition("=")[2]) for r in rows} - used))


def at(spark: SparkSession, database: str, number: int | None = None) -> Commit:
    """The tables of a database at a commit, the newest complete one by default, to read them as one."""
    found = Commit.__new__(Commit)
    numbers = [number] if number is not None else commits(spark, database)[::-1]
    for n in numbers:
        base = state(spark, database, n)
        if base is not None:
            found.spark, found.database, found.number, found.base, found.changes = spark, database, n, base, {}
            return found
    raise LookupError(f"{database} has no commit {number if number is not None else ''}")
