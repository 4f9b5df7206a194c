"""Persons, deaths and observation periods from the yearly eligibility table.

Rows are collapsed before anything is grouped by person, so a person with very many copies
of a row still reaches a task as at most years x bands rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes
from .keys import unsent
from .vocab import CONDITION, used


def person_latest(jk: DataFrame) -> DataFrame:
    """Sex and region of the last year; ties and duplicate rows all stay.

    The last year is aggregated (map-side first) and joined back, so no window ever holds
    the rows of a person.
    """
    last = jk.groupBy("person_id").agg(F.max("stnd_y").alias("stnd_y"))
    return (
        jk.select("person_id", "stnd_y", "sex", "sgg")
        .join(unsent(last), ["person_id", "stnd_y"])
        .drop("stnd_y")
    )


def age_group_profile(jk: DataFrame) -> DataFrame:
    """Rows, first and last year per person and age band."""
    return jk.groupBy("person_id", "age_group").agg(
        F.count("age_group").alias("n"),
        F.min("stnd_y").alias("min_year"),
        F.max("stnd_y").alias("max_year"),
    )


def birth_year(jk: DataFrame) -> DataFrame:
    """Estimated birth year and the rule that gave it, in one pass over the age bands.

    A band holds five years. The band that shows a person for exactly five years, or whose
    entry year is known from the preceding band, gives the year; otherwise the first seen
    band does. Rule 4 (bands longer than five years) and repeated eligibility rows of the
    chosen year give several rows per person, and rule 1 on the newborn band gives year + 5:
    all as in the source system.
    """
    person = Window.partitionBy("person_id")
    by_band = person.orderBy("age_group")
    band = F.col("age_group")
    follows = (F.lag("age_group").over(by_band) + 1 == band) & (
        F.lag("max_year").over(by_band) + 1 == F.col("min_year")
    )
    # At most one row per band reaches the person windows.
    bands = age_group_profile(jk).withColumn("follows", F.coalesce(follows, F.lit(False)))
    full, longer = F.col("n") == 5, F.col("n") > 5
    facts = bands.select(
        "*",
        F.count("*").over(person).alias("bands"),
        F.max(F.when(full, band)).over(person).alias("full_band"),
        F.max("n").over(person).alias("max_n"),
        F.min(band).over(person).alias("low_band"),
        F.min(F.when(F.col("follows"), F.struct("min_year", "age_group")))
        .over(person)
        .alias("change"),
    )
    many, short = F.col("bands") > 1, F.col("max_n") < 5
    newborn = F.col("low_band") == 0
    no_full, no_change = F.col("full_band").isNull(), F.col("change").isNull()
    # (rule, what holds for the person, which of the person's bands is chosen)
    rules = (
        ("1", many & ~no_full, band == F.col("full_band")),
        ("2", many & short & newborn, band == 0),
        (
            "3-1",
            many & short & ~newborn & ~no_change,
            F.struct("min_year", "age_group") == F.col("change"),
        ),
        ("3-2", many & short & ~newborn & no_change, band == F.col("low_band")),
        ("4", many & no_full & ~short, longer),
        ("5", ~many & full, F.lit(True)),
        ("6", ~many & short & newborn, F.lit(True)),
        ("7", ~many & short & ~newborn, F.lit(True)),
        ("8", ~many & longer, F.lit(True)),
    )
    rule = codes.null("string")
    for name, applies, chosen in reversed(rules):
        rule = F.when(applies & chosen, F.lit(name)).otherwise(rule)
    chosen = (
        facts.withColumn("rule", rule)
        .where(F.col("rule").isNotNull())
        .select("person_id", "rule", F.col("min_year").alias("stnd_y"))
    )
    year = F.when(F.col("rule").isin("2", "6"), F.col("stnd_y")).otherwise(
        F.col("stnd_y") - (band - 1) * 5
    )
    rows = jk.select("person_id", "stnd_y", "age_group")
    return (
        rows.join(unsent(chosen), ["person_id", "stnd_y"])
        .select("person_id", year.cast("int").alias("year_of_birth"), "rule")
    )


def person(jk: DataFrame) -> DataFrame:
    return (
        birth_year(jk)
        .join(unsent(person_latest(jk)), "person_id")
        .select(
            "person_id",
            codes.gender_concept(F.col("sex")).alias("gender_concept_id"),
            "year_of_birth",
            F.lit(codes.RACE_KOREAN).alias("race_concept_id"),
            F.lit(codes.ETHNICITY_NOT_HISPANIC).alias("ethnicity_concept_id"),
            F.col("sgg").try_cast("int").alias("location_id"),
            F.col("person_id").cast("string").alias("person_source_value"),
            F.col("sex").cast("string").alias("gender_source_value"),
        )
    )


def death(jk: DataFrame, code_map: DataFrame, death_map: DataFrame) -> DataFrame:
    """Deaths dated to the end of the month, or to 31 December where only the cause is known.

    A NULL month with a cause gives no death, and a cause with several targets gives several
    rows, as in the source system; the primary-key check reports the latter.
    """
    causes = (
        used(code_map, CONDITION)
        .select("source_code", "target_concept_id")
        .unionByName(death_map.select("source_code", "target_concept_id"))
    )
    month, cause = F.col("dth_ym"), F.col("dth_code1")
    date = F.when(month != "", F.last_day(codes.ymd(F.concat(month, F.lit("01"))))).when(
        cause != "", codes.last_day(F.col("stnd_y"))
    )
    return (
        jk.where((month != "") | ((month == "") & (cause != "")))
        .select("person_id", date.alias("death_date"), cause.alias("cause_source_value"))
        .join(causes, F.col("cause_source_value") == F.col("source_code"), "left")
        .select(
            "person_id",
            "death_date",
            F.lit(codes.DEATH_TYPE).alias("death_type_concept_id"),
            F.col("target_concept_id").alias("cause_concept_id"),
            "cause_source_value",
        )
    )


def observation_period(jk: DataFrame, persons: DataFrame, deaths: DataFrame) -> DataFrame:
    """Eligibility years cut to birth year and death, merged where at most a day lies between.

    Only distinct years reach the window: copies of a year cannot change a merged period.
    """
    years = jk.select("person_id", "stnd_y").distinct()
    births = persons.select("person_id", "year_of_birth").distinct()
    ends = deaths.select("person_id", "death_date").distinct()
    year_end = codes.last_day(F.col("stnd_y"))
    spans = (
        years.join(unsent(births), "person_id")
        .join(unsent(ends), "person_id", "left")
        .select(
            "person_id",
            codes.first_day(F.greatest("stnd_y", "year_of_birth")).alias("start"),
            F.least(year_end, F.col("death_date")).alias("end"),
        )
        .where(F.col("start") < F.col("end"))
    )
    ordered = Window.partitionBy("person_id").orderBy("start", "end")
    gap = F.datediff(F.col("start"), F.lag("end").over(ordered))
    run = F.sum(F.when(F.col("gap") > 1, 1).otherwise(0)).over(
        ordered.rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        spans.withColumn("gap", gap)
        .withColumn("run", run)
        .groupBy("person_id", "run")
        .agg(
            F.min("start").alias("observation_period_start_date"),
            F.max("end").alias("observation_period_end_date"),
        )
        .select(
            "person_id",
            "observation_period_start_date",
            "observation_period_end_date",
            F.lit(codes.PERIOD_TYPE).alias("period_type_concept_id"),
        )
    )
