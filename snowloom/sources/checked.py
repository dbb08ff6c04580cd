"""Files read with what does not parse beside the data, and columns found by the names in each file's header."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snowloom.functions import as_schema
from snowloom.operators.conform import cast_to
from snowloom.session import materialize

_RAW, _FILE = "__raw", "__file"


class Checked(NamedTuple):
    """Rows that parse, and ``(file, reason, raw)`` of what does not. Nothing read is in neither."""

    rows: DataFrame
    rejects: DataFrame


def plain_name(header: str) -> str:
    """A column's name as it is compared: lower case, words joined by one underscore. ``Laureate ID`` is ``laureate_id``."""
    return re.sub(r"[^0-9a-z]+", "_", header.lower()).strip("_")


def _files(spark: SparkSession, path: str) -> list[str]:
    """The data files of a folder, or the file itself."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [f.getPath() for f in fs.listStatus(where) if f.isFile()]
    return sorted(str(p) for p in found if not p.getName().startswith(("_", ".")))


def _first_line(spark: SparkSession, file: str) -> str | None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(file)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(where)
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(where)
    if codec is not None:
        stream = codec.createInputStream(stream)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        line = reader.readLine()
        return None if line is None else line.removeprefix("﻿")
    finally:
        reader.close()


def _columns(line: str, wanted: Mapping[str, str], separator: str, quote: str) -> tuple[list[str | None], str | None]:
    """For each field of a header the column it is, and what is wrong with the header."""
    fields = [f.strip().strip(quote) for f in line.split(separator)]
    found = [wanted.get(plain_name(f)) for f in fields]
    missing = sorted(set(wanted.values()) - set(found))
    twice = sorted({c for c in found if c is not None and found.count(c) > 1})
    if missing:
        return found, f"header without {', '.join(missing)}"
    return found, f"header has {', '.join(twice)} twice" if twice else None


def read_csv_checked(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    spellings: Mapping[str, Sequence[str]] | None = None,
    separator: str = ",",
    quote: str = '"',
) -> Checked:
    """Read quoted files with a header each into the columns and types of ``schema``.

    Columns are found by name in each file's own header, so files may order them differently and have others, which
    are left out. Names are compared by ``plain_name``; ``spellings`` gives further names of a column. A row with too few or too
    many fields is rejected with its text; a file whose header lacks a column, or has it twice, is rejected as a whole,
    with the header as text. A value that does not fit its type becomes null, as in ``read_csv``; ``audit_cast`` counts those.

    The driver reads one line of each file. Files of one header are parsed together, once; the result is written, as
    both parts are read from it.
    """
    fields = as_schema(schema).fields
    wanted = {plain_name(s): f.name for f in fields for s in (f.name, *(spellings or {}).get(f.name, ()))}
    by_header: dict[str, list[str]] = {}
    for file in _files(spark, path):
        line = _first_line(spark, file)
        if line is not None:
            by_header.setdefault(line, []).append(file)
    text = ", ".join(f"`{f.name}` string" for f in fields)
    parts, wrong = [], []
    for line, files in by_header.items():
        found, reason = _columns(line, wanted, separator, quote)
        if reason:
            wrong += [(file, reason, line) for file in files]
            continue
        names = [c if c is not None else f"__other{i}" for i, c in enumerate(found)]
        read = T.StructType([T.StructField(c, T.StringType()) for c in (*names, _RAW)])
        reader = spark.read.schema(read).option("header", True).option("enforceSchema", True).option("sep", separator)
        reader = reader.option("quote", quote).option("escape", "\\").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RAW)
        df = reader.csv(files)
        # Every column is asked for, so that no field goes uncounted.
        whole = F.struct(*names).isNotNull()
        parts.append(df.where(whole).select(*[f.name for f in fields], _RAW, F.col("_metadata.file_path").alias(_FILE), *[c for c in names if c.startswith("__other")]))
    union = None
    for part in parts:
        union = part if union is None else union.unionByName(part, allowMissingColumns=True)
    rejects = spark.createDataFrame(wrong, "file string, reason string, raw string")
    if union is None:
        return Checked(spark.createDataFrame([], as_schema(schema)), rejects)
    read = materialize(union, "checked-csv")
    rows = cast_to(read.where(F.col(_RAW).isNull()).select(*[f.name for f in fields]), T.StructType(fields))
    broken = read.where(F.col(_RAW).isNotNull()).select(F.col(_FILE).alias("file"), F.lit("wrong number of fields").alias("reason"), F.col(_RAW).alias("raw"))
    return Checked(rows, rejects.unionByName(broken))


def read_json_checked(spark: SparkSession, path: str, schema: T.StructType | str) -> Checked:
    """Read JSON lines into ``schema``. A line that is no JSON object, or whose values do not fit, is rejected with its text."""
    fields = as_schema(schema).fields
    read = T.StructType([*fields, T.StructField(_RAW, T.StringType())])
    df = spark.read.schema(read).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RAW).json(path)
    parsed = materialize(df.select("*", F.col("_metadata.file_path").alias(_FILE)), "checked-json")
    rows = parsed.where(F.col(_RAW).isNull()).select(*[f.name for f in fields])
    broken = parsed.where(F.col(_RAW).isNotNull()).select(F.col(_FILE).alias("file"), F.lit("no object of these types").alias("reason"), F.col(_RAW).alias("raw"))
    return Checked(rows, broken)
