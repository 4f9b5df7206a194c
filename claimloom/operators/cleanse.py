"""Cleansing: events must lie inside one observation period of their person.

The source system deletes by id. Event ids are unique, except where a code has more than nine
targets (``quality.dq_line_keys`` counts those), so each row is tested by itself. Payer periods,
whose ids may repeat, are kept or dropped by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ranges
from .keys import unsent


def inside_period(
    events: DataFrame, periods: DataFrame, start: str, end: str | None = None
) -> DataFrame:
    """Events that fit a period: a semi-join on person and year with the dates as residual.

    A NULL end never fits.
    """
    return ranges.in_a_period(events, periods, F.col(start), F.col(end) if end else None)


def cleanse_visit(events: DataFrame, periods: DataFrame) -> DataFrame:
    return inside_period(events, periods, "visit_start_date", "visit_end_date")


def cleanse_condition(events: DataFrame, periods: DataFrame) -> DataFrame:
    return inside_period(events, periods, "condition_start_date", "condition_end_date")


def cleanse_drug(events: DataFrame, periods: DataFrame) -> DataFrame:
    return inside_period(events, periods, "drug_exposure_start_date", "drug_exposure_end_date")


def cleanse_procedure(events: DataFrame, periods: DataFrame) -> DataFrame:
    return inside_period(events, periods, "procedure_date")


def cleanse_device(events: DataFrame, periods: DataFrame) -> DataFrame:
    return inside_period(
        events, periods, "device_exposure_start_date", "device_exposure_end_date"
    )


def cleanse_measurement(events: DataFrame, periods: DataFrame) -> DataFrame:
    return inside_period(events, periods, "measurement_date")


def cleanse_payer_plan(events: DataFrame, periods: DataFrame) -> DataFrame:
    fits = inside_period(
        events, periods, "payer_plan_period_start_date", "payer_plan_period_end_date"
    )
    kept = fits.select("payer_plan_period_id")
    return events.join(unsent(kept), "payer_plan_period_id", "left_semi").select(*events.columns)


def patch_person(persons: DataFrame, overrides: DataFrame) -> DataFrame:
    """Correct the gender of listed persons (person_id, gender_concept_id, gender_source_value)."""
    fixes = overrides.select(
        "person_id",
        F.col("gender_concept_id").alias("_concept"),
        F.col("gender_source_value").alias("_source"),
    )
    return (
        persons.join(unsent(fixes), "person_id", "left")
        .withColumn("gender_concept_id", F.coalesce("_concept", "gender_concept_id"))
        .withColumn("gender_source_value", F.coalesce("_source", "gender_source_value"))
        .select(*persons.columns)
    )


def device_quantity_zero_to_one(devices: DataFrame) -> DataFrame:
    quantity = F.col("quantity")
    return devices.withColumn("quantity", F.when(quantity == 0, F.lit(1)).otherwise(quantity))
