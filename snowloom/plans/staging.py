"""Landing of the sources as dated batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from snowloom import sinks, sources
from snowloom.operators import conform
from snowloom.plans import schemas


def land_cities(table: DataFrame, target: str, batch_date: date | str | None = None) -> None:
    """Land the full city list, as ``sources.read_jdbc`` gives it."""
    rows = conform.cast_to(conform.rename(table, schemas.CITY_NAMES), schemas.CITY_TYPES)
    sinks.land(rows, target, batch_date, schemas.STAGING_LAYOUTS["cities"])


def land_countries(spark: SparkSession, path: str, target: str, batch_date: date | str | None = None) -> None:
    """Land the full country list from its files."""
    rows = sources.read_csv(spark, path, schemas.COUNTRY_FILE, schemas.COUNTRY_NAMES)
    sinks.land(rows, target, batch_date, schemas.STAGING_LAYOUTS["countries"])


def land_laureates(spark: SparkSession, path: str, target: str, batch_date: date | str | None = None) -> None:
    """Land the new laureates from their files, and note whose rows they are."""
    rows = sources.read_csv(spark, path, schemas.LAUREATE_FILE)
    sinks.land(rows, target, batch_date, schemas.STAGING_LAYOUTS["laureates"], index=["laureate_id"])


def land_laureates_by_header(
    spark: SparkSession, path: str, target: str, batch_date: date | str, spellings: Mapping[str, Sequence[str]] | None = None
) -> None:
    """Land the new laureates from files that name their columns in any order; what does not parse is kept beside them.

    Names are those of the schema, however they are written (``Full Name``, ``full_name``), or of ``spellings``. Rejected rows
    are in the table ``<target>__rejects`` under the batch's date, in place of those of an earlier landing.
    """
    read = sources.read_csv_checked(spark, path, schemas.LAUREATE_FILE, schemas.LAUREATE_SPELLINGS | (spellings or {}))
    sinks.land(read.rows, target, batch_date, schemas.STAGING_LAYOUTS["laureates"], index=["laureate_id"])
    rejects = sinks.stamp(read.rejects, batch_date)
    sinks.replace_slice(rejects, f"{target}__rejects", sinks.Layout(("upd_date",)), {"upd_date": batch_date})


def land_code_list(spark: SparkSession, name: str, path: str, target: str) -> None:
    """Store one of the code lists; they come once."""
    field, column = schemas.CODE_LISTS[name]
    sinks.create_table(sources.read_code_list(spark, path, field, "country_code", column), target)
