"""Conditions, drugs, procedures and devices from keyed claim lines.

All builders read the frame of ``keys.keyed_lines`` (line + header + serial) and take the
mapped, ambiguous and unmapped rows of a target table from one left join with the code map,
so each source is scanned once per target table. ``kinds`` picks a subset of the branches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from . import ranges, vocab
from .keys import unsent

MAPPED, AMBIGUOUS, UNMAPPED = "mapped", "ambiguous", "unmapped"
DRUG_LINES = ("3", "4", "5")
PROCEDURE_LINES = ("1", "2")
DEVICE_LINES = ("7", "8")


def _classified(
    lines: DataFrame, code: Column, code_map: DataFrame, kind_of: dict[str, str]
) -> DataFrame:
    """Lines with target, rank and kind; a code in none of the uses is one 'unmapped' row.

    ``kind_of`` names the uses of the code map and the kind each stands for. A NULL code
    matches nothing and is dropped, as NOT IN does.
    """
    kind = codes.null("string")
    for use, name in kind_of.items():
        kind = F.when(F.col("use") == use, name).otherwise(kind)
    table = vocab.used(code_map, *kind_of).select(
        "source_code", "target_concept_id", "rn", kind.alias("kind")
    )
    return (
        lines.where(code.isNotNull())
        .join(table, code == F.col("source_code"), "left")
        .withColumns(
            {
                "kind": F.coalesce("kind", F.lit(UNMAPPED)),
                "rn": F.coalesce("rn", F.lit(1)),
                "target_concept_id": F.coalesce("target_concept_id", F.lit(0)),
            }
        )
    )


def _keep(kinds: tuple[str, ...], rules: dict[str, Column]) -> Column:
    keep = F.lit(False)
    for kind in kinds:
        keep = keep | ((F.col("kind") == kind) & rules[kind])
    return keep


def _amounts(prescription: bool) -> tuple[Column, Column]:
    """Days of use and the product of the three frequency fields of the source."""
    days = codes.positive_or_one(F.col("mdcn_exec_freq"))
    dose = codes.positive_or_one(F.col("dd_mqty_freq"))
    daily = codes.positive_or_one(F.col("dd_exec_freq" if prescription else "dd_mqty_exec_freq"))
    if prescription:
        return days, dose * daily * days
    return days, daily * days * dose


def _span_end(start: Column, days: Column) -> Column:
    """start + days - 1, the day count truncated towards zero."""
    return F.date_add(start, (days - 1).try_cast("int"))


# --- conditions ---------------------------------------------------------------------------


def condition_occurrence(
    k40: DataFrame,
    periods: DataFrame,
    code_map: DataFrame,
    kinds: tuple[str, ...] = (MAPPED, UNMAPPED),
) -> DataFrame:
    """Diagnosis lines inside an observation period.

    The period is tested with the line's date while the header's date is stored, as in the
    source system. A code mapped only to another domain gives no row at all.
    """
    line_day = codes.ymd(F.col("recu_fr_dt"))
    lines = _classified(
        k40,
        F.col("sick_sym"),
        code_map,
        {vocab.CONDITION: MAPPED, vocab.ELSEWHERE: vocab.ELSEWHERE},
    ).where(F.col("kind").isin(*kinds))
    start = codes.ymd(F.col("header_dt"))
    dated = lines.withColumn("_line_day", line_day)
    return (
        ranges.with_period(dated, periods, F.col("_line_day"))
        .select(
            codes.event_id(F.col("master_seq"), F.col("rn")).alias("condition_occurrence_id"),
            "person_id",
            F.col("target_concept_id").alias("condition_concept_id"),
            start.alias("condition_start_date"),
            codes.visit_end(
                start, F.col("form_cd"), F.col("in_pat_cors_type"), F.col("vscn")
            ).alias("condition_end_date"),
            codes.condition_type(F.col("seq_no")).alias("condition_type_concept_id"),
            F.col("key_seq").alias("visit_occurrence_id"),
            F.col("sick_sym").alias("condition_source_value"),
        )
    )


# --- drugs --------------------------------------------------------------------------------


def drug_lines(
    lines: DataFrame,
    code_map: DataFrame,
    prescription: bool,
    kinds: tuple[str, ...] = (MAPPED, UNMAPPED),
) -> DataFrame:
    """Drug exposures of one source: any line with a drug code, or a drug line without map."""
    code = F.col("div_cd")
    rows = _classified(lines, code, code_map, {vocab.DRUG: MAPPED}).where(
        _keep(kinds, {MAPPED: F.lit(True), UNMAPPED: F.col("div_type_cd").isin(*DRUG_LINES)})
    )
    days, quantity = _amounts(prescription)
    start = codes.ymd(F.col("recu_fr_dt"))
    if prescription:
        route, sig, route_text = codes.null("int"), codes.null("string"), codes.null("string")
    else:
        sig, item = codes.zero_pad(F.col("clause_cd")), codes.zero_pad(F.col("item_cd"))
        route = codes.route_concept(sig, item)
        route_text = F.concat(sig, F.lit("/"), item)
    return rows.select(
        codes.event_id(F.col("master_seq"), F.col("rn")).alias("drug_exposure_id"),
        "person_id",
        F.col("target_concept_id").alias("drug_concept_id"),
        start.alias("drug_exposure_start_date"),
        _span_end(start, days).alias("drug_exposure_end_date"),
        codes.drug_type(F.col("form_cd")).alias("drug_type_concept_id"),
        quantity.alias("quantity"),
        days.try_cast("int").alias("days_supply"),
        sig.alias("sig"),
        route.alias("route_concept_id"),
        F.col("key_seq").alias("visit_occurrence_id"),
        code.alias("drug_source_value"),
        route_text.alias("route_source_value"),
    )


def _with_death(drug: DataFrame, deaths: DataFrame) -> DataFrame:
    first = deaths.groupBy("person_id").agg(F.min("death_date").alias("_death"))
    return drug.join(unsent(first), "person_id", "left")


def _alive_at_start() -> Column:
    return F.coalesce(F.col("_death") >= F.col("drug_exposure_start_date"), F.lit(True))


def _end_by_death() -> Column:
    end = F.col("drug_exposure_end_date")
    late = (F.col("_death") < end) | (F.col("_death") < F.col("drug_exposure_start_date"))
    return F.when(late, F.col("_death")).otherwise(end)


def drug_after_death_removed(drug: DataFrame, deaths: DataFrame) -> DataFrame:
    """Exposures that start after a death of the person are dropped."""
    return _with_death(drug, deaths).where(_alive_at_start()).select(*drug.columns)


def drug_end_clipped_to_death(drug: DataFrame, deaths: DataFrame) -> DataFrame:
    """An exposure that ends after death ends on the day of death.

    With several deaths per person the source picks any; the earliest is taken here.
    """
    return (
        _with_death(drug, deaths)
        .withColumn("drug_exposure_end_date", _end_by_death())
        .select(*drug.columns)
    )


def drug_exposure(
    k30: DataFrame, k60: DataFrame, deaths: DataFrame, code_map: DataFrame
) -> DataFrame:
    """The whole table: both sources, then both death rules from one join with the deaths."""
    drug = drug_lines(k30, code_map, False).unionByName(
        drug_lines(k60, code_map, True)
    )
    return (
        _with_death(drug, deaths)
        .where(_alive_at_start())
        .withColumn("drug_exposure_end_date", _end_by_death())
        .select(*drug.columns)
    )


# --- procedures ---------------------------------------------------------------------------


def procedure_lines(
    lines: DataFrame,
    code_map: DataFrame,
    prescription: bool,
    kinds: tuple[str, ...] = (MAPPED, AMBIGUOUS, UNMAPPED),
) -> DataFrame:
    """Procedures of one source, matched on the first five characters of the code."""
    rows = _classified(
        lines,
        F.substring("div_cd", 1, 5),
        code_map,
        {vocab.PROCEDURE_ONLY: MAPPED, vocab.PROCEDURE_AMBIGUOUS: AMBIGUOUS},
    )
    line_type = F.col("div_type_cd")
    rows = rows.where(
        _keep(
            kinds,
            {
                MAPPED: ~line_type.isin(*DRUG_LINES, *DEVICE_LINES),
                AMBIGUOUS: line_type.isin(*PROCEDURE_LINES),
                UNMAPPED: line_type.isin(*PROCEDURE_LINES),
            },
        )
    )
    _, quantity = _amounts(prescription)
    return rows.select(
        codes.event_id(F.col("master_seq"), F.col("rn")).alias("procedure_occurrence_id"),
        "person_id",
        F.col("target_concept_id").alias("procedure_concept_id"),
        codes.ymd(F.col("recu_fr_dt")).alias("procedure_date"),
        F.lit(codes.PROCEDURE_TYPE).alias("procedure_type_concept_id"),
        quantity.try_cast("int").alias("quantity"),
        F.col("key_seq").alias("visit_occurrence_id"),
        F.col("div_cd").alias("procedure_source_value"),
    )


def procedure_dedup(procedure: DataFrame, drug: DataFrame) -> DataFrame:
    """Procedures whose id is already taken by a drug exposure are dropped."""
    taken = drug.select(F.col("drug_exposure_id").alias("procedure_occurrence_id"))
    return procedure.join(unsent(taken), "procedure_occurrence_id", "left_anti")


def procedure_occurrence(
    k30: DataFrame, k60: DataFrame, drug: DataFrame, code_map: DataFrame
) -> DataFrame:
    rows = procedure_lines(k30, code_map, False).unionByName(
        procedure_lines(k60, code_map, True)
    )
    return procedure_dedup(rows, drug).select(*rows.columns)


# --- devices ------------------------------------------------------------------------------


def device_lines(
    lines: DataFrame,
    code_map: DataFrame,
    prescription: bool,
    kinds: tuple[str, ...] = (MAPPED, AMBIGUOUS, UNMAPPED),
) -> DataFrame:
    """Devices of one source. The quantity is amount / unit cost where that is at least one.

    The source system guards its dose fields by comparing text with '0' before the numeric
    test; the numeric guard of the other tables is used here for all of them.
    """
    rows = _classified(
        lines,
        F.col("div_cd"),
        code_map,
        {vocab.DEVICE_ONLY: MAPPED, vocab.DEVICE_AMBIGUOUS: AMBIGUOUS},
    )
    line_type = F.col("div_type_cd")
    rows = rows.where(
        _keep(
            kinds,
            {
                MAPPED: ~line_type.isin(*PROCEDURE_LINES, *DRUG_LINES),
                AMBIGUOUS: line_type.isin(*DEVICE_LINES),
                UNMAPPED: line_type.isin(*DEVICE_LINES),
            },
        )
    )
    days, usage = _amounts(prescription)
    amount, unit = F.col("amt").cast("double"), F.col("un_cost").cast("double")
    quantity = F.when((unit > 0) & (amount >= unit), F.try_divide(amount, unit)).otherwise(usage)
    start = codes.ymd(F.col("recu_fr_dt"))
    return rows.select(
        codes.event_id(F.col("master_seq"), F.col("rn")).alias("device_exposure_id"),
        "person_id",
        F.col("target_concept_id").alias("device_concept_id"),
        start.alias("device_exposure_start_date"),
        _span_end(start, days).alias("device_exposure_end_date"),
        F.lit(codes.DEVICE_TYPE).alias("device_type_concept_id"),
        quantity.try_cast("int").alias("quantity"),
        F.col("key_seq").alias("visit_occurrence_id"),
        F.col("div_cd").alias("device_source_value"),
    )


def device_exposure(k30: DataFrame, k60: DataFrame, code_map: DataFrame) -> DataFrame:
    return device_lines(k30, code_map, False).unionByName(
        device_lines(k60, code_map, True)
    )
