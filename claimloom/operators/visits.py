"""Care sites, locations and visits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes
from .keys import unsent


def location(regions: DataFrame) -> DataFrame:
    """Region codes (code, province, district) as CDM locations."""
    return regions.select(
        F.col("code").cast("int").alias("location_id"),
        F.col("province").alias("address_1"),
        F.concat_ws(" ", "code", "district").alias("address_2"),
        F.col("province").alias("city"),
        codes.null("string").alias("state"),
        codes.null("string").alias("zip"),
        F.lit("KOREA").alias("county"),
        F.col("code").alias("location_source_value"),
    )


def care_site(yk: DataFrame) -> DataFrame:
    """Institutions as of their latest year; differing rows of that year all stay.

    Rows are made distinct first, so copies of an institution row do not reach the window.
    """
    rows = yk.select("ykiho_id", "stnd_y", "ykiho_gubun_cd", "org_type", "ykiho_sido").distinct()
    last = F.max("stnd_y").over(Window.partitionBy("ykiho_id"))
    kind = F.col("ykiho_gubun_cd")
    return (
        rows.withColumn("_last", last)
        .where(F.col("stnd_y") == F.col("_last"))
        .select(
            F.col("ykiho_id").cast("int").alias("care_site_id"),
            codes.place_of_service(kind).alias("place_of_service_concept_id"),
            F.col("ykiho_sido").try_cast("int").alias("location_id"),
            F.col("ykiho_id").cast("string").alias("care_site_source_value"),
            F.concat(kind, F.lit("/"), codes.two_digits(F.col("org_type"))).alias(
                "place_of_service_source_value"
            ),
        )
        .distinct()
    )


def visit_occurrence_claims(t20: DataFrame) -> DataFrame:
    """One visit per claim header: a projection, no shuffle."""
    form, arrival = F.col("form_cd"), F.col("in_pat_cors_type")
    start = codes.ymd(F.col("recu_fr_dt"))
    return t20.select(
        F.col("key_seq").cast("bigint").alias("visit_occurrence_id"),
        "person_id",
        codes.visit_concept(form, arrival).alias("visit_concept_id"),
        start.alias("visit_start_date"),
        codes.visit_end(start, form, arrival, F.col("vscn")).alias("visit_end_date"),
        F.lit(codes.VISIT_TYPE).alias("visit_type_concept_id"),
        F.col("ykiho_id").cast("int").alias("care_site_id"),
        F.col("key_seq").cast("string").alias("visit_source_value"),
    )


def screening_master(gj: DataFrame, seq: DataFrame) -> DataFrame:
    """Screening rows with their serial. Duplicate person-years fan out as in the source."""
    serial = seq.where(F.col("source_table") == "GJT").select("master_seq", "person_id", "hchk_year")
    return gj.join(unsent(serial), ["person_id", "hchk_year"])


def visit_occurrence_screening(gj: DataFrame, seq: DataFrame) -> DataFrame:
    day = codes.first_day(F.col("hchk_year"))
    return screening_master(gj.select("person_id", "hchk_year"), seq).select(
        F.col("master_seq").alias("visit_occurrence_id"),
        "person_id",
        F.lit(codes.VISIT_OUTPATIENT).alias("visit_concept_id"),
        day.alias("visit_start_date"),
        day.alias("visit_end_date"),
        F.lit(codes.VISIT_TYPE).alias("visit_type_concept_id"),
        codes.null("int").alias("care_site_id"),
        F.col("master_seq").cast("string").alias("visit_source_value"),
    )


def visit_occurrence(t20: DataFrame, gj: DataFrame, seq: DataFrame) -> DataFrame:
    return visit_occurrence_claims(t20).unionByName(visit_occurrence_screening(gj, seq))
