"""Yearly raw files: union of columns, stacked load, incremental load, table profiles."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def _read(spark: SparkSession, path: str) -> DataFrame:
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    # Codes keep leading zeros: every CSV column is text.
    return spark.read.csv(path, header=True)


def _years(spark: SparkSession, paths: Iterable[str]) -> list[tuple[str, DataFrame]]:
    """The files that exist; a missing year is reported and skipped, any other error stops."""
    found = []
    for path in paths:
        try:
            found.append((path, _read(spark, path)))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("skipped %s: no such file", path)
    return found


def union_columns(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """All column names of the yearly files, sorted. Reads file metadata only."""
    return sorted({c for _, df in _years(spark, paths) for c in df.columns})


def load_years(
    spark: SparkSession, base: str, pattern: str, years: Iterable[int], year_column: str = "load_year"
) -> DataFrame:
    """Stack the yearly files; a column a year lacks is NULL there.

    ``pattern`` names a file with ``{year}``. The year becomes a column, for partitioning.
    """
    years = list(years)
    paths = {f"{base.rstrip('/')}/{pattern.format(year=y)}": y for y in years}
    frames = [df.withColumn(year_column, F.lit(paths[p])) for p, df in _years(spark, paths)]
    if not frames:
        raise FileNotFoundError(f"no file of {pattern} under {base} for {years}")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.select(*sorted(c for c in stacked.columns if c != year_column), year_column)


def normalise_strings(df: DataFrame) -> DataFrame:
    """Drop trailing blanks, which the source database ignores in comparisons."""
    return df.select(
        *[
            F.rtrim(f.name).alias(f.name) if f.dataType.typeName() == "string" else F.col(f.name)
            for f in df.schema
        ]
    )


def write_raw(df: DataFrame, path: str, first: bool, partition_by: tuple[str, ...] = ()) -> None:
    """The first load replaces the table, later loads append."""
    df.write.mode("overwrite" if first else "append").partitionBy(*partition_by).parquet(path)


def load_single(spark: SparkSession, source: str, target: str) -> DataFrame:
    """One file replaces the table."""
    write_raw(_read(spark, source), target, first=True)
    return spark.read.parquet(target)


def ingest_incremental_batch(
    spark: SparkSession,
    base: str,
    pattern: str,
    years: Iterable[int],
    start_year: int,
    target: str,
) -> list[int]:
    """Append the years from ``start_year`` on that the target lacks, one by one.

    A bad year does not stop the rest. Returns the years loaded, so a second call returns none.
    See ``streaming.ingest`` for the form that remembers files.
    """
    present = loaded_years(spark, target)
    loaded = []
    for year in years:
        if year < start_year or year in present:
            continue
        path = f"{base.rstrip('/')}/{pattern.format(year=year)}"
        try:
            write_raw(_read(spark, path).withColumn("load_year", F.lit(year)), target, first=False)
            loaded.append(year)
        except Exception as error:  # noqa: BLE001 - any failure is one lost year
            log.error("year %s not loaded: %s", year, str(error).splitlines()[0])
    return loaded


def loaded_years(spark: SparkSession, target: str) -> set[int]:
    """The years a target holds; a handful of numbers, none if there is no target yet."""
    try:
        stored = spark.read.parquet(target)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()
    return {row.load_year for row in stored.select("load_year").distinct().collect()}


def profile_table(df: DataFrame, name: str, sample: int = 5) -> DataFrame:
    """Columns, types, row count and up to ``sample`` example values per column."""
    columns = df.columns
    layout = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("type"),
            )
            for i, f in enumerate(df.schema)
        ]
    )
    counted = df.agg(F.count("*").alias("rows")).select("rows", F.inline(layout))
    head = df.limit(sample).select(*[F.col(c).cast("string").alias(c) for c in columns])
    examples = (
        head.unpivot([], columns, "column_name", "value")
        .groupBy("column_name")
        .agg(F.collect_list("value").alias("examples"))
    )
    return counted.join(examples, "column_name", "left").select(
        F.lit(name).alias("table_name"), "position", "column_name", "type", "rows", "examples"
    )


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables of a catalog database with their kind."""
    tables = spark.catalog.listTables(database)
    return spark.createDataFrame(
        [(t.namespace[0] if t.namespace else None, t.name, t.tableType) for t in tables],
        "database string, table_name string, type string",
    )
