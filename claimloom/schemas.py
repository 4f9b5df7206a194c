"""Table layouts of the CDM v5.3.1 and its vocabulary, with key metadata derived from them."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of the CDM v5.3.1. "!" marks NOT NULL; i = integer, b = bigint,
# f = float, d = date, t = datetime, otherwise the length of the text (0 = unlimited).
# Ids that grow with the number of claims, and era ids, are bigint.
_CDM = """
cdm_source: cdm_source_name 255!, cdm_source_abbreviation 25, cdm_holder 255,
    source_description 0, source_documentation_reference 255, cdm_etl_reference 255,
    source_release_date d, cdm_release_date d, cdm_version 10, vocabulary_version 20
metadata: metadata_concept_id i!, metadata_type_concept_id i!, name 250!, value_as_string 0,
    value_as_concept_id i, metadata_date d, metadata_datetime t
person: person_id b!, gender_concept_id i!, year_of_birth i!, month_of_birth i, day_of_birth i,
    birth_datetime t, race_concept_id i!, ethnicity_concept_id i!, location_id i, provider_id i,
    care_site_id i, person_source_value 50, gender_source_value 50, gender_source_concept_id i,
    race_source_value 50, race_source_concept_id i, ethnicity_source_value 50,
    ethnicity_source_concept_id i
observation_period: observation_period_id b!, person_id b!, observation_period_start_date d!,
    observation_period_end_date d!, period_type_concept_id i!
specimen: specimen_id i!, person_id b!, specimen_concept_id i!, specimen_type_concept_id i!,
    specimen_date d!, specimen_datetime t, quantity f, unit_concept_id i,
    anatomic_site_concept_id i, disease_status_concept_id i, specimen_source_id 50,
    specimen_source_value 50, unit_source_value 50, anatomic_site_source_value 50,
    disease_status_source_value 50
death: person_id b!, death_date d!, death_datetime t, death_type_concept_id i!,
    cause_concept_id i, cause_source_value 50, cause_source_concept_id i
visit_occurrence: visit_occurrence_id b!, person_id b!, visit_concept_id i!, visit_start_date d!,
    visit_start_datetime t, visit_end_date d!, visit_end_datetime t, visit_type_concept_id i!,
    provider_id i, care_site_id i, visit_source_value 50, visit_source_concept_id i,
    admitting_source_concept_id i, admitting_source_value 50, discharge_to_concept_id i,
    discharge_to_source_value 50, preceding_visit_occurrence_id b
visit_detail: visit_detail_id i!, person_id b!, visit_detail_concept_id i!,
    visit_detail_start_date d!, visit_detail_start_datetime t, visit_detail_end_date d!,
    visit_detail_end_datetime t, visit_detail_type_concept_id i!, provider_id i, care_site_id i,
    admitting_source_concept_id i, discharge_to_concept_id i, preceding_visit_detail_id i,
    visit_detail_source_value 50, visit_detail_source_concept_id i, admitting_source_value 50,
    discharge_to_source_value 50, visit_detail_parent_id i, visit_occurrence_id b!
procedure_occurrence: procedure_occurrence_id b!, person_id b!, procedure_concept_id i!,
    procedure_date d!, procedure_datetime t, procedure_type_concept_id i!, modifier_concept_id i,
    quantity i, provider_id i, visit_occurrence_id b, visit_detail_id i,
    procedure_source_value 50, procedure_source_concept_id i, modifier_source_value 50
drug_exposure: drug_exposure_id b!, person_id b!, drug_concept_id i!, drug_exposure_start_date d!,
    drug_exposure_start_datetime t, drug_exposure_end_date d!, drug_exposure_end_datetime t,
    verbatim_end_date d, drug_type_concept_id i!, stop_reason 20, refills i, quantity f,
    days_supply i, sig 0, route_concept_id i, lot_number 50, provider_id i, visit_occurrence_id b,
    visit_detail_id i, drug_source_value 50, drug_source_concept_id i, route_source_value 50,
    dose_unit_source_value 50
device_exposure: device_exposure_id b!, person_id b!, device_concept_id i!,
    device_exposure_start_date d!, device_exposure_start_datetime t, device_exposure_end_date d,
    device_exposure_end_datetime t, device_type_concept_id i!, unique_device_id 50, quantity i,
    provider_id i, visit_occurrence_id b, visit_detail_id i, device_source_value 100,
    device_source_concept_id i
condition_occurrence: condition_occurrence_id b!, person_id b!, condition_concept_id i!,
    condition_start_date d!, condition_start_datetime t, condition_end_date d,
    condition_end_datetime t, condition_type_concept_id i!, stop_reason 20, provider_id i,
    visit_occurrence_id b, visit_detail_id i, condition_source_value 50,
    condition_source_concept_id i, condition_status_source_value 50, condition_status_concept_id i
measurement: measurement_id b!, person_id b!, measurement_concept_id i!, measurement_date d!,
    measurement_datetime t, measurement_time 10, measurement_type_concept_id i!,
    operator_concept_id i, value_as_number f, value_as_concept_id i, unit_concept_id i,
    range_low f, range_high f, provider_id i, visit_occurrence_id b, visit_detail_id i,
    measurement_source_value 50, measurement_source_concept_id i, unit_source_value 50,
    value_source_value 50
note: note_id i!, person_id b!, note_date d!, note_datetime t, note_type_concept_id i!,
    note_class_concept_id i!, note_title 250, note_text 0, encoding_concept_id i!,
    language_concept_id i!, provider_id i, visit_occurrence_id b, visit_detail_id i,
    note_source_value 50
note_nlp: note_nlp_id i!, note_id i!, section_concept_id i, snippet 250, offset 250,
    lexical_variant 250!, note_nlp_concept_id i, note_nlp_source_concept_id i, nlp_system 250,
    nlp_date d!, nlp_datetime t, term_exists 1, term_temporal 50, term_modifiers 2000
observation: observation_id b!, person_id b!, observation_concept_id i!, observation_date d!,
    observation_datetime t, observation_type_concept_id i!, value_as_number f,
    value_as_string 60, value_as_concept_id i, qualifier_concept_id i, unit_concept_id i,
    provider_id i, visit_occurrence_id b, visit_detail_id i, observation_source_value 50,
    observation_source_concept_id i, unit_source_value 50, qualifier_source_value 50
fact_relationship: domain_concept_id_1 i!, fact_id_1 i!, domain_concept_id_2 i!, fact_id_2 i!,
    relationship_concept_id i!
location: location_id i!, address_1 50, address_2 50, city 50, state 2, zip 9, county 20,
    location_source_value 50
care_site: care_site_id i!, care_site_name 255, place_of_service_concept_id i, location_id i,
    care_site_source_value 50, place_of_service_source_value 50
provider: provider_id i!, provider_name 255, npi 20, dea 20, specialty_concept_id i,
    care_site_id i, year_of_birth i, gender_concept_id i, provider_source_value 50,
    specialty_source_value 50, specialty_source_concept_id i, gender_source_value 50,
    gender_source_concept_id i
payer_plan_period: payer_plan_period_id b!, person_id b!, payer_plan_period_start_date d!,
    payer_plan_period_end_date d!, payer_concept_id i, payer_source_value 50,
    payer_source_concept_id i, plan_concept_id i, plan_source_value 50, plan_source_concept_id i,
    sponsor_concept_id i, sponsor_source_value 50, sponsor_source_concept_id i,
    family_source_value 50, stop_reason_concept_id i, stop_reason_source_value 50,
    stop_reason_source_concept_id i
cost: cost_id b!, cost_event_id b!, cost_domain_id 20!, cost_type_concept_id i!,
    currency_concept_id i, total_charge f, total_cost f, total_paid f, paid_by_payer f,
    paid_by_patient f, paid_patient_copay f, paid_patient_coinsurance f,
    paid_patient_deductible f, paid_by_primary f, paid_ingredient_cost f, paid_dispensing_fee f,
    payer_plan_period_id b, amount_allowed f, revenue_code_concept_id i,
    revenue_code_source_value 50, drg_concept_id i, drg_source_value 50
cohort: cohort_definition_id i!, subject_id i!, cohort_start_date d!, cohort_end_date d!
cohort_attribute: cohort_definition_id i!, subject_id i!, cohort_start_date d!,
    cohort_end_date d!, attribute_definition_id i!, value_as_number f, value_as_concept_id i
drug_era: drug_era_id b!, person_id b!, drug_concept_id i!, drug_era_start_date d!,
    drug_era_end_date d!, drug_exposure_count b, gap_days i
dose_era: dose_era_id b!, person_id b!, drug_concept_id i!, unit_concept_id i, dose_value f!,
    dose_era_start_date d!, dose_era_end_date d!
condition_era: condition_era_id b!, person_id b!, condition_concept_id i!,
    condition_era_start_date d!, condition_era_end_date d!, condition_occurrence_count b
"""

_VOCABULARY = """
concept: concept_id i!, concept_name 255!, domain_id 20!, vocabulary_id 20!, concept_class_id 20!,
    standard_concept 1, concept_code 50!, valid_start_date d!, valid_end_date d!, invalid_reason 1
vocabulary: vocabulary_id 20!, vocabulary_name 255!, vocabulary_reference 255!,
    vocabulary_version 255!, vocabulary_concept_id i!
domain: domain_id 20!, domain_name 255!, domain_concept_id i!
concept_class: concept_class_id 20!, concept_class_name 255!, concept_class_concept_id i!
concept_relationship: concept_id_1 i!, concept_id_2 i!, relationship_id 20!, valid_start_date d!,
    valid_end_date d!, invalid_reason 1
relationship: relationship_id 20!, relationship_name 255!, is_hierarchical 1!,
    defines_ancestry 1!, reverse_relationship_id 20!, relationship_concept_id i!
concept_synonym: concept_id i!, concept_synonym_name 1000!, language_concept_id i!
concept_ancestor: ancestor_concept_id i!, descendant_concept_id i!, min_levels_of_separation i!,
    max_levels_of_separation i!
source_to_concept_map: source_code 50!, source_concept_id i!, source_vocabulary_id 20!,
    source_code_description 255, target_concept_id i!, target_vocabulary_id 20!,
    valid_start_date d!, valid_end_date d!, invalid_reason 1, domain_id 20!
drug_strength: drug_concept_id i!, ingredient_concept_id i!, amount_value f,
    amount_unit_concept_id i, numerator_value f, numerator_unit_concept_id i,
    denominator_value f, denominator_unit_concept_id i, box_size i, valid_start_date d!,
    valid_end_date d!, invalid_reason 1
cohort_definition: cohort_definition_id i!, cohort_definition_name 255!,
    cohort_definition_description 0, definition_type_concept_id i!, cohort_definition_syntax 0,
    subject_concept_id i!, cohort_initiation_date d
attribute_definition: attribute_definition_id i!, attribute_name 255!, attribute_description 0,
    attribute_type_concept_id i!, attribute_syntax 0
"""
# Concept columns of the CDM without a foreign key.
_NO_KEY = {
    ("visit_occurrence", "visit_concept_id"),
    ("visit_detail", "visit_detail_concept_id"),
    ("note_nlp", "note_nlp_source_concept_id"),
    ("cost", "cost_type_concept_id"),
    ("cost", "revenue_code_concept_id"),
}
_NO_CONCEPT_KEYS = {"payer_plan_period", "metadata"}
# End of fixed values.

_KINDS = {
    "i": T.IntegerType(),
    "b": T.LongType(),
    "f": T.DoubleType(),
    "d": T.DateType(),
    "t": T.TimestampType(),
}


def _parse(text: str) -> dict[str, T.StructType]:
    tables: dict[str, T.StructType] = {}
    for entry in text.strip().replace("\n    ", " ").splitlines():
        name, columns = entry.split(": ", 1)
        fields = []
        for column in columns.split(", "):
            field, kind = column.split()
            required, kind = kind.endswith("!"), kind.rstrip("!")
            length = int(kind) if kind.isdigit() else 0
            fields.append(
                T.StructField(
                    field,
                    _KINDS.get(kind, T.StringType()),
                    not required,
                    {"length": length} if length else None,
                )
            )
        tables[name] = T.StructType(fields)
    return tables


CDM = _parse(_CDM)
VOCABULARY = _parse(_VOCABULARY)

PRIMARY_KEYS = {
    name: ("person_id",) if name == "death" else (f"{name}_id",)
    for name in CDM
    if name == "death" or f"{name}_id" in CDM[name].names
} | {
    "cohort": ("cohort_definition_id", "subject_id", "cohort_start_date", "cohort_end_date"),
    "cohort_attribute": (
        "cohort_definition_id",
        "subject_id",
        "cohort_start_date",
        "cohort_end_date",
        "attribute_definition_id",
    ),
}

UNIQUE = {"concept_synonym": ("concept_id", "concept_synonym_name", "language_concept_id")}

_TARGETS = {
    "person_id": "person",
    "provider_id": "provider",
    "care_site_id": "care_site",
    "location_id": "location",
    "visit_occurrence_id": "visit_occurrence",
    "preceding_visit_occurrence_id": "visit_occurrence",
    "preceding_visit_detail_id": "visit_detail",
    "visit_detail_parent_id": "visit_detail",
    "payer_plan_period_id": "payer_plan_period",
    "note_id": "note",
    "attribute_definition_id": "attribute_definition",
}


def _cdm_relations():
    for table, schema in CDM.items():
        for column in schema.names:
            if column == f"{table}_id" or (table, column) in _NO_KEY:
                continue
            if "concept_id" in column:
                if table not in _NO_CONCEPT_KEYS:
                    yield table, column, "concept", "concept_id"
            elif column in _TARGETS:
                parent = _TARGETS[column]
                yield table, column, parent, f"{parent}_id"
            elif (table, column) == ("cohort_attribute", "cohort_definition_id"):
                yield table, column, "cohort_definition", column


def _vocabulary_relations():
    names = {
        "domain_id": "domain",
        "concept_class_id": "concept_class",
        "vocabulary_id": "vocabulary",
    }
    for table, schema in VOCABULARY.items():
        for column in schema.names:
            if column == "reverse_relationship_id":
                yield table, column, "relationship", "relationship_id"
            elif "concept_id" in column:
                if (table, column) != ("concept", "concept_id"):
                    yield table, column, "concept", "concept_id"
            elif table == "concept" and column in names:
                yield table, column, names[column], column
            elif table == "concept_relationship" and column == "relationship_id":
                yield table, column, "relationship", column
            elif column in ("source_vocabulary_id", "target_vocabulary_id"):
                yield table, column, "vocabulary", "vocabulary_id"


# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [*_vocabulary_relations(), *_cdm_relations()]

# Raw tables: columns the conversion reads. Codes and dates are text.
RAW = {
    "jk": "person_id bigint, stnd_y int, sex int, age_group int, sgg string, ipsn_type_cd string, "
    "ctrb_pt_type_cd string, dfab_grd_cd string, dth_ym string, dth_code1 string",
    "t20": "key_seq bigint, person_id bigint, recu_fr_dt string, form_cd string, "
    "in_pat_cors_type string, vscn int, ykiho_id int, sub_sick string, dmd_tramt double, "
    "edec_tramt double, edec_jbrdn_amt double, edec_sbrdn_amt double, dmd_drg_no string",
    "t30": "key_seq bigint, seq_no int, recu_fr_dt string, div_cd string, div_type_cd string, "
    "mdcn_exec_freq string, dd_mqty_exec_freq string, dd_mqty_freq string, clause_cd string, "
    "item_cd string, amt double, un_cost double",
    "t40": "key_seq bigint, seq_no int, sick_sym string, recu_fr_dt string",
    "t60": "key_seq bigint, seq_no int, recu_fr_dt string, div_cd string, div_type_cd string, "
    "mdcn_exec_freq string, dd_mqty_freq string, dd_exec_freq string, amt double, un_cost double",
    "yk": "ykiho_id int, stnd_y int, ykiho_gubun_cd string, org_type string, ykiho_sido string",
}
