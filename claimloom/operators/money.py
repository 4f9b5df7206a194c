"""Payer plan periods and costs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from . import vocab
from .keys import PRESCRIPTION, RANGES, TREATMENT, SerialRanges, unsent

# Drug types whose costs are taken per source, and the payer.
COSTED_DRUG_TYPES = {TREATMENT: 38000180, PRESCRIPTION: 38000177}
PAYER = "National Health Insurance Service"
# End of fixed values.


def payer_plan_period(jk: DataFrame, deaths: DataFrame) -> DataFrame:
    """One period per eligibility row, ended by death; years after death end before they start.

    The id is the person followed by the year, in costs too (the source adds them here).
    """
    year = F.col("stnd_y")
    return jk.join(unsent(deaths.select("person_id", "death_date")), "person_id", "left").select(
        codes.payer_plan_id(F.col("person_id"), year).alias("payer_plan_period_id"),
        "person_id",
        codes.first_day(year).alias("payer_plan_period_start_date"),
        F.least(codes.last_day(year), F.col("death_date")).alias("payer_plan_period_end_date"),
        F.lit(PAYER).alias("payer_source_value"),
        F.col("ipsn_type_cd").alias("plan_source_value"),
    )


def _cost(
    rows: DataFrame, event: str, domain: Column, date: str, amounts: dict[str, Column]
) -> DataFrame:
    def amount(name: str) -> Column:
        return amounts.get(name, codes.null("double")).cast("double").alias(name)

    return rows.select(
        "person_id",
        F.col(event).alias("cost_id"),
        F.col(event).alias("cost_event_id"),
        domain.alias("cost_domain_id"),
        F.lit(codes.COST_TYPE).alias("cost_type_concept_id"),
        F.lit(codes.CURRENCY_WON).alias("currency_concept_id"),
        amount("total_charge"),
        amount("total_cost"),
        amount("total_paid"),
        amount("paid_by_payer"),
        amount("paid_by_patient"),
        codes.payer_plan_id(F.col("person_id"), F.date_format(date, "yyyy")).alias(
            "payer_plan_period_id"
        ),
        amounts.get("drg_source_value", codes.null("string")).alias("drg_source_value"),
    )


def cost_visit(visit: DataFrame, t20: DataFrame) -> DataFrame:
    header = t20.select(
        F.col("key_seq").alias("visit_occurrence_id"),
        "person_id",
        "dmd_tramt",
        "edec_tramt",
        "edec_jbrdn_amt",
        "edec_sbrdn_amt",
        "dmd_drg_no",
    )
    events = visit.select("visit_occurrence_id", "person_id", "visit_start_date")
    return _cost(
        events.join(unsent(header), ["visit_occurrence_id", "person_id"]),
        "visit_occurrence_id",
        F.lit("Visit"),
        "visit_start_date",
        {
            "total_charge": F.col("dmd_tramt"),
            "total_paid": F.col("edec_tramt"),
            "paid_by_payer": F.col("edec_jbrdn_amt"),
            "paid_by_patient": F.col("edec_sbrdn_amt"),
            "drg_source_value": F.col("dmd_drg_no"),
        },
    )


def _drug_events(drug: DataFrame, rule: Column) -> DataFrame:
    return drug.where(rule).select(
        F.lit("Drug").alias("domain"),
        F.col("drug_exposure_id").alias("event"),
        "person_id",
        F.col("drug_exposure_start_date").alias("day"),
    )


def _procedure_events(procedure: DataFrame) -> DataFrame:
    return procedure.select(
        F.lit("Procedure").alias("domain"),
        F.col("procedure_occurrence_id").alias("event"),
        "person_id",
        F.col("procedure_date").alias("day"),
    )


def _device_events(device: DataFrame, code_map: DataFrame) -> DataFrame:
    """Devices without the codes that are valid procedure codes too."""
    procedures = vocab.used(code_map, vocab.PROCEDURE)
    return vocab.unmapped_codes(device, procedures, F.col("device_source_value")).select(
        F.lit("Device").alias("domain"),
        F.col("device_exposure_id").alias("event"),
        "person_id",
        F.col("device_exposure_start_date").alias("day"),
    )


def _line_cost(events: DataFrame, *keyed: DataFrame) -> DataFrame:
    """Line amounts by serial and person. Serial ranges of the sources do not overlap."""
    amounts = reduce(
        DataFrame.unionByName, [k.select("master_seq", "person_id", "amt") for k in keyed]
    )
    own = events.withColumn("master_seq", codes.decode_event_id(F.col("event")))
    return _cost(
        own.join(unsent(amounts), ["master_seq", "person_id"]), "event", F.col("domain"), "day",
        {"total_cost": F.col("amt")},
    )


def cost_drug(
    drug: DataFrame, keyed: DataFrame, source: str, all_types: bool = False,
    ranges: SerialRanges = RANGES,
) -> DataFrame:
    """Drug costs of one source; events of the other are filtered by id range.

    As in the source system only one drug type per source is costed, and the prescription
    type is one the drug stage never writes; ``all_types`` costs every exposure.
    """
    own = ranges.holds_event(F.col("drug_exposure_id"), source)
    if not all_types:
        own = own & (F.col("drug_type_concept_id") == COSTED_DRUG_TYPES[source])
    return _line_cost(_drug_events(drug, own), keyed)


def cost_procedure(
    procedure: DataFrame, keyed: DataFrame, source: str, ranges: SerialRanges = RANGES
) -> DataFrame:
    own = ranges.holds_event(F.col("procedure_occurrence_id"), source)
    return _line_cost(_procedure_events(procedure.where(own)), keyed)


def cost_device(
    device: DataFrame, keyed: DataFrame, source: str, code_map: DataFrame,
    ranges: SerialRanges = RANGES,
) -> DataFrame:
    own = ranges.holds_event(F.col("device_exposure_id"), source)
    return _line_cost(_device_events(device.where(own), code_map), keyed)


def cost(
    visit: DataFrame, drug: DataFrame, procedure: DataFrame, device: DataFrame, t20: DataFrame,
    k30: DataFrame, k60: DataFrame, code_map: DataFrame, ranges: SerialRanges = RANGES,
) -> DataFrame:
    """Visit costs and, from a single join with the lines of both sources, all line costs."""
    costed = reduce(
        Column.__or__,
        [
            ranges.holds_event(F.col("drug_exposure_id"), source)
            & (F.col("drug_type_concept_id") == kind)
            for source, kind in COSTED_DRUG_TYPES.items()
        ],
    )
    events = (
        _drug_events(drug, costed)
        .unionByName(_procedure_events(procedure))
        .unionByName(_device_events(device, code_map))
    )
    return cost_visit(visit, t20).unionByName(_line_cost(events, k30, k60))
