"""Joins of dated rows with periods of their person, by calendar year.

Person and date range alone compare all rows of a person with all of the person's periods. Here
a period stands in each year it touches and a row in the year it begins, so that a row meets only
periods of that year, and the rows of one person spread over years. A row and a period meet once at
most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import unsent

FIRST, LAST = "observation_period_start_date", "observation_period_end_date"
#: The bin of rows that end before they begin: their period may lie in any of the years between.
ANY_YEAR = -1


def row_bin(start: Column, end: Column | None = None) -> Column:
    """The year of a row; none without dates, as such a row is in no period."""
    if end is None:
        return F.year(start)
    return F.when(end >= start, F.year(start)).when(end < start, F.lit(ANY_YEAR))


def binned_periods(periods: DataFrame) -> DataFrame:
    """(_person, _bin, first and last date): each period once a year it touches, and once for all."""
    years = F.sequence(F.year(FIRST), F.year(LAST))
    return periods.select(
        F.col("person_id").alias("_person"),
        FIRST,
        LAST,
        F.explode(F.concat(years, F.array(F.lit(ANY_YEAR)))).alias("_bin"),
    )


def _inside(start: Column, end: Column | None) -> Column:
    return (
        (F.col("person_id") == F.col("_person"))
        & (F.col("_row_bin") == F.col("_bin"))
        & (start >= F.col(FIRST))
        & ((start if end is None else end) <= F.col(LAST))
    )


def in_a_period(rows: DataFrame, periods: DataFrame, start: Column, end: Column | None = None) -> DataFrame:
    """Rows that begin and end within one period; a NULL date is in none."""
    binned = rows.withColumn("_row_bin", row_bin(start, end))
    return binned.join(unsent(binned_periods(periods)), _inside(start, end), "left_semi").drop("_row_bin")


def with_period(rows: DataFrame, periods: DataFrame, day: Column) -> DataFrame:
    """Each row with each period that holds its day, as columns of the period."""
    binned = rows.withColumn("_row_bin", row_bin(day))
    return binned.join(unsent(binned_periods(periods)), _inside(day, None)).drop("_row_bin", "_bin", "_person")
