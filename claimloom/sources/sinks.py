"""Writing CDM tables: layout of columns, stored form, stage counts, source metadata."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import codes
from ..work import CODEC

# The description of the source that goes into cdm_source.
SOURCE_NAME = "The National Health Insurance Service–National Sample Cohort"
SOURCE_ABBREVIATION = "NHIS-NSC"
SOURCE_HOLDER = "The National Health Insurance Service in South Korea"
CDM_VERSION = "v5.3.1"
# End of fixed values.

# Column that follows person_id inside a file, so statistics skip row groups by concept.
SORT_COLUMN = {
    "visit_occurrence": "visit_concept_id",
    "procedure_occurrence": "procedure_concept_id",
    "drug_exposure": "drug_concept_id",
    "device_exposure": "device_concept_id",
    "condition_occurrence": "condition_concept_id",
    "measurement": "measurement_concept_id",
    "observation": "observation_concept_id",
    "drug_era": "drug_concept_id",
    "dose_era": "drug_concept_id",
    "condition_era": "condition_concept_id",
}


def conform(df: DataFrame, table: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The declared columns in order, cast; columns the stage does not fill are NULL.

    Columns of ``keep`` that are not declared come first, as they are.

    A text that is no number, or a number out of range, becomes NULL and shows in the NOT
    NULL check; floats in integer columns lose their fraction.
    """
    given = set(df.columns)
    layout = schemas.CDM.get(table) or schemas.VOCABULARY[table]
    return df.select(
        *[c for c in keep if c not in layout.names],
        *[
            (
                F.col(f.name).try_cast(f.dataType)
                if f.name in given
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in layout
        ],
    )


def _date_column(table: str) -> str | None:
    """The first date that a table must have: that of its rows."""
    for field in schemas.CDM.get(table) or schemas.VOCABULARY.get(table) or ():
        if field.dataType.typeName() == "date" and not field.nullable:
            return field.name
    return None


def measures(columns: Iterable[str], table: str) -> list[Column]:
    """Rows, rows without a whole primary key, first and last date of a table's rows."""
    given = set(columns)
    keys = [F.col(c).isNull() for c in schemas.PRIMARY_KEYS.get(table, ()) if c in given]
    missing = keys[0] if keys else F.lit(False)
    for key in keys[1:]:
        missing = missing | key
    date = _date_column(table)
    day = F.col(date) if date in given else F.lit(None).cast("date")
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(missing).alias("null_keys"),
        F.min(day).alias("first_date"),
        F.max(day).alias("last_date"),
    ]


def observed(df: DataFrame, table: str, seen: Observation | None) -> DataFrame:
    """``df``, whose measures ``seen`` holds once an action has run over it.

    They are gathered by the tasks that hold the rows anyway, here those that write them, and
    count each partition once even where a task is repeated.
    """
    return df.observe(seen, *measures(df.columns, table)) if seen else df


def write_cdm(
    df: DataFrame, table: str, out: str, seen: Observation | None = None
) -> DataFrame:
    """Replace a CDM table; files are sorted by person and concept for row-group skipping.

    The sort is local to the tasks that already hold the rows, so writing adds no shuffle
    and no person is gathered in one task.
    """
    path = f"{out.rstrip('/')}/{table}"
    rows = conform(df, table)
    order = [c for c in ("person_id", SORT_COLUMN.get(table)) if c and c in rows.columns]
    if order:
        rows = rows.sortWithinPartitions(*order)
    rows = observed(rows, table, seen)
    rows.write.mode("overwrite").parquet(path, compression=CODEC)
    return df.sparkSession.read.parquet(path)


def write_bucketed(
    df: DataFrame,
    table: str,
    buckets: int,
    key: str = "person_id",
    path: str | None = None,
    seen: Observation | None = None,
) -> DataFrame:
    """Store as a catalog table bucketed by person and sorted by person and concept.

    Joins on the person then need no shuffle. Rows of one person share a bucket, so this layout
    suits cohorts without dominating persons; ``write_cdm`` has no such limit. With ``path``
    the files lie there and the table is external.
    """
    name = table.split(".")[-1].removeprefix("indexed_")
    concept = SORT_COLUMN.get(name)
    order = [key, *([concept] if concept in df.columns else [])]
    writer = observed(df, name, seen).write.mode("overwrite").bucketBy(buckets, key).sortBy(*order)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def stage_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, from the files' footers where the tables are stored."""
    rows = [(name, df.count()) for name, df in tables.items()]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "table_name string, rows bigint")


def stage_log(
    spark: SparkSession, entries: list[tuple[str, str, dict[str, Any], float]]
) -> DataFrame:
    """What each stage wrote, with its measures, and how long the stage took.

    ``entries`` are (stage, table, measures, seconds); a stage that writes several tables has an
    entry for each, with the seconds of the whole stage.
    """
    names = ("rows", "null_keys", "first_date", "last_date")
    return spark.createDataFrame(
        [(stage, table, *(seen[n] for n in names), s) for stage, table, seen, s in entries],
        "stage string, table_name string, rows bigint, null_keys bigint, first_date date, "
        "last_date date, seconds double",
    )


def cdm_source(
    spark: SparkSession,
    concept: DataFrame,
    today: dt.date,
    description: str | None = None,
    documentation: str | None = None,
    etl_reference: str | None = None,
) -> DataFrame:
    """One row; the vocabulary version is the last end date of a standard concept before today."""
    version = concept.where(
        (F.col("standard_concept") == "S") & (F.col("valid_end_date") < F.lit(today))
    ).agg(F.max("valid_end_date").cast("string").alias("vocabulary_version"))
    return version.select(
        F.lit(SOURCE_NAME).alias("cdm_source_name"),
        F.lit(SOURCE_ABBREVIATION).alias("cdm_source_abbreviation"),
        F.lit(SOURCE_HOLDER).alias("cdm_holder"),
        F.lit(description).cast("string").alias("source_description"),
        F.lit(documentation).cast("string").alias("source_documentation_reference"),
        F.lit(etl_reference).cast("string").alias("cdm_etl_reference"),
        codes.null("date").alias("source_release_date"),
        F.lit(today).alias("cdm_release_date"),
        F.lit(CDM_VERSION).alias("cdm_version"),
        "vocabulary_version",
    )
