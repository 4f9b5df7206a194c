"""Small fixed maps of the conversion, as DataFrames. All are under a hundred rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Death causes given as code ranges, with their concept.
DEATH_CAUSES = """
A00-A09,4134887,Infectious disease of digestive tract
A15-A19,434557,Tuberculosis
A30-A49,432545,Bacterial infectious disease
A50-A64,440647,Sexually transmitted infectious disease
A75-A79,432545,Bacterial infectious disease
A80-A89,4028070,Infectious disease of central nervous system
A90-A99,4347554,Viral hemorrhagic fever
B00-B09,440029,Viral disease
B15-B19,4291005,Viral hepatitis
B20-B24,4221489,AIDS-associated disorder
B25-B34,440029,Viral disease
B35-B49,433701,Mycosis
B50-B64,442176,Protozoan infection
B65-B83,432251,Disease caused by parasite
B90-B94,444201,Post-infectious disorder
F00-F09,374009,Organic mental disorder
F10-F19,40483111,Mental disorder due to drug
F20-F29,436073,Psychotic disorder
F30-F39,444100,Mood disorder
F40-F48,444243,Neurosis
F50-F59,4333000,Behavioral syndrome associated with physiological disturbance and physical factors
F70-F79,440389,Mental retardation
F80-F89,435244,Developmental disorder
F99-F99,432586,Mental disorder
J46,4145356,Severe persistent asthma
S00-S09,375415,Injury of head
S10-S19,24818,Injury of neck
S20-S29,4094683,Chest injury
S30-S39,200588,Injury of abdomen
S40-S49,4130851,Injury of upper extremity
S50-S59,136779,Disorder of forearm
S60-S69,80004,Injury of hand
S70-S79,4130852,Injury of lower extremity
S80-S89,444131,Injury of lower leg
T00-T07,440921,Traumatic injury
T08-T14,4022201,Injury of musculoskeletal system
T15-T19,4053838,Foreign body
T20-T25,4123196,Burn of skin of body region
T26-T28,198030,Burn of internal organ
T29-T32,442013,Burn
T33-T35,441487,Frostbite
T36-T50,438028,Poisoning by drug AND/OR medicinal substance
T51-T65,40481346,Poisoning due to chemical substance
T66-T78,4167864,Effect of exposure to physical force
T79-T79,4211546,Traumatic complication of injury
T80-T88,442019,Complication of procedure
T90-T98,443403,Sequela
"""

# Item, id suffix, answer, concept, type, unit, value concept, value.
MEASUREMENT_ITEMS = """
HEIGHT,01,0,3036277,44818701,4122378,,
WEIGHT,02,0,3025315,44818701,4122383,,
WAIST,03,0,3016258,44818701,4122378,,
BP_HIGH,04,0,3028737,44818701,4118323,,
BP_LWST,05,0,3012888,44818701,4118323,,
BLDS,06,0,46235168,44818702,4121396,,
TOT_CHOLE,07,0,3027114,44818702,4121396,,
TRIGLYCERIDE,08,0,3022038,44818702,4121396,,
HDL_CHOLE,09,0,3023752,44818702,4121396,,
LDL_CHOLE,10,0,3028437,44818702,4121396,,
HMG,11,0,3000963,44818702,4121395,,
GLY_CD,12,1,3009261,44818702,,9189,
GLY_CD,12,2,3009261,44818702,,4127785,
GLY_CD,12,3,3009261,44818702,,4123508,
GLY_CD,12,4,3009261,44818702,,4126673,
GLY_CD,12,5,3009261,44818702,,4125547,
GLY_CD,12,6,3009261,44818702,,4126674,
OLIG_OCCU_CD,13,1,437038,44818702,,9189,
OLIG_OCCU_CD,13,2,437038,44818702,,4127785,
OLIG_OCCU_CD,13,3,437038,44818702,,4123508,
OLIG_OCCU_CD,13,4,437038,44818702,,4126673,
OLIG_OCCU_CD,13,5,437038,44818702,,4125547,
OLIG_OCCU_CD,13,6,437038,44818702,,4126674,
OLIG_PH,14,0,3015736,44818702,8482,,
OLIG_PROTE_CD,15,1,3014051,44818702,,9189,
OLIG_PROTE_CD,15,2,3014051,44818702,,4127785,
OLIG_PROTE_CD,15,3,3014051,44818702,,4123508,
OLIG_PROTE_CD,15,4,3014051,44818702,,4126673,
OLIG_PROTE_CD,15,5,3014051,44818702,,4125547,
OLIG_PROTE_CD,15,6,3014051,44818702,,4126674,
CREATININE,16,0,2212294,44818702,4121396,,
SGOT_AST,17,0,2212597,44818702,4118000,,
SGPT_ALT,18,0,2212598,44818702,4118000,,
GAMMA_GTP,19,0,4289475,44818702,4118000,,
"""

# Same columns as the measurement items.
OBSERVATION_ITEMS = """
HCHK_PMH_CD1,20,1,4058267,44814721,,,
HCHK_PMH_CD1,20,2,43021368,44814721,,,
HCHK_PMH_CD1,20,3,4058725,44814721,,,
HCHK_PMH_CD1,20,4,4058286,44814721,,,
HCHK_PMH_CD1,20,5,4077352,44814721,,,
HCHK_PMH_CD1,20,6,4077982,44814721,,,
HCHK_PMH_CD1,20,7,4058709,44814721,,,
HCHK_PMH_CD1,20,8,4144289,44814721,,,
HCHK_PMH_CD1,20,9,4195979,44814721,,,
HCHK_PMH_CD2,21,1,4058267,44814721,,,
HCHK_PMH_CD2,21,2,43021368,44814721,,,
HCHK_PMH_CD2,21,3,4058725,44814721,,,
HCHK_PMH_CD2,21,4,4058286,44814721,,,
HCHK_PMH_CD2,21,5,4077352,44814721,,,
HCHK_PMH_CD2,21,6,4077982,44814721,,,
HCHK_PMH_CD2,21,7,4058709,44814721,,,
HCHK_PMH_CD2,21,8,4144289,44814721,,,
HCHK_PMH_CD2,21,9,4195979,44814721,,,
HCHK_PMH_CD3,22,1,4058267,44814721,,,
HCHK_PMH_CD3,22,2,43021368,44814721,,,
HCHK_PMH_CD3,22,3,4058725,44814721,,,
HCHK_PMH_CD3,22,4,4058286,44814721,,,
HCHK_PMH_CD3,22,5,4077352,44814721,,,
HCHK_PMH_CD3,22,6,4077982,44814721,,,
HCHK_PMH_CD3,22,7,4058709,44814721,,,
HCHK_PMH_CD3,22,8,4144289,44814721,,,
HCHK_PMH_CD3,22,9,4195979,44814721,,,
HCHK_APOP_PMH_YN,23,1,4077982,44814721,,,
HCHK_HDISE_PMH_YN,24,1,4077352,44814721,,,
HCHK_HPRTS_PMH_YN,25,1,4058286,44814721,,,
HCHK_DIABML_PMH_YN,26,1,4058709,44814721,,,
HCHK_HPLPDM_PMH_YN,27,1,4058275,44814721,,,
HCHK_ETCDSE_PMH_YN,28,1,44834226,44814721,,,
HCHK_PHSS_PMH_YN,29,1,4058267,44814721,,,
FMLY_LIVER_DISE_PATIEN_YN,30,1,4144266,44814721,,,
FMLY_HPRTS_PATIEN_YN,31,0,4053372,44814721,,,
FMLY_HPRTS_PATIEN_YN,31,1,4050816,44814721,,,
FMLY_APOP_PATIEN_YN,32,0,4175587,44814721,,,
FMLY_APOP_PATIEN_YN,32,1,4169009,44814721,,,
FMLY_HDISE_PATIEN_YN,33,0,4050792,44814721,,,
FMLY_HDISE_PATIEN_YN,33,1,4173498,44814721,,,
FMLY_DIABML_PATIEN_YN,34,0,4051106,44814721,,,
FMLY_DIABML_PATIEN_YN,34,1,4051114,44814721,,,
FMLY_CANCER_PATIEN_YN,35,0,4051100,44814721,,,
FMLY_CANCER_PATIEN_YN,35,1,4171594,44814721,,,
SMK_STAT_TYPE_RSPS_CD,36,1,4222303,44814721,,,
SMK_STAT_TYPE_RSPS_CD,36,2,4310250,44814721,,,
SMK_STAT_TYPE_RSPS_CD,36,3,4276526,44814721,,,
SMK_TERM_RSPS_CD,37,1,40766364,44818704,,,2.5
SMK_TERM_RSPS_CD,37,2,40766364,44818704,,,7.5
SMK_TERM_RSPS_CD,37,3,40766364,44818704,,,15
SMK_TERM_RSPS_CD,37,4,40766364,44818704,,,25
SMK_TERM_RSPS_CD,37,5,40766364,44818704,,,30
CUR_SMK_TERM_RSPS_CD,38,0,40766364,44818704,9448,,
CUR_DSQTY_RSPS_CD,39,0,40766929,44818704,45756923,,
PAST_SMK_TERM_RSPS_CD,40,0,40766364,44818704,9448,,
PAST_DSQTY_RSPS_CD,41,0,40766930,44818704,45756923,,
DSQTY_RSPS_CD,42,1,40766929,44818704,45756954,,0.25
DSQTY_RSPS_CD,42,2,40766929,44818704,45756954,,0.75
DSQTY_RSPS_CD,42,3,40766929,44818704,45756954,,1.5
DSQTY_RSPS_CD,42,4,40766929,44818704,45756954,,2
DRNK_HABIT_RSPS_CD,43,1,40771103,44818704,,45882527,
DRNK_HABIT_RSPS_CD,43,2,40771103,44818704,,45885249,
DRNK_HABIT_RSPS_CD,43,3,40771103,44818704,,45881653,
DRNK_HABIT_RSPS_CD,43,4,40771103,44818704,,45885248,
DRNK_HABIT_RSPS_CD,43,5,40771103,44818704,,45879676,
TM1_DRKQTY_RSPS_CD,44,1,3037705,44818704,4045131,,3.5
TM1_DRKQTY_RSPS_CD,44,2,3037705,44818704,4045131,,7
TM1_DRKQTY_RSPS_CD,44,3,3037705,44818704,4045131,,10.5
TM1_DRKQTY_RSPS_CD,44,4,3037705,44818704,4045131,,14
EXERCI_FREQ_RSPS_CD,45,1,4036426,44818704,,45882527,
EXERCI_FREQ_RSPS_CD,45,2,4036426,44818704,,45881653,
EXERCI_FREQ_RSPS_CD,45,3,4036426,44818704,,45885248,
EXERCI_FREQ_RSPS_CD,45,4,4036426,44818704,,45883166,
EXERCI_FREQ_RSPS_CD,45,5,4036426,44818704,,45879676,
MOV20_WEK_FREQ_ID,46,0,82020119,44818704,,,
MOV30_WEK_FREQ_ID,47,0,82020120,44818704,,,
WLK30_WEK_FREQ_ID,48,0,82020121,44818704,,,
CTRB_PT_TYPE_CD,49,0,3004572,44814721,4155146,,
CTRB_PT_TYPE_CD,49,1,3004572,44814721,4155146,,
CTRB_PT_TYPE_CD,49,2,3004572,44814721,4155146,,
CTRB_PT_TYPE_CD,49,3,3004572,44814721,4155146,,
CTRB_PT_TYPE_CD,49,4,3004572,44814721,4155146,,
CTRB_PT_TYPE_CD,49,5,3004572,44814721,4155146,,
CTRB_PT_TYPE_CD,49,6,3004572,44814721,4155146,,
CTRB_PT_TYPE_CD,49,7,3004572,44814721,4155146,,
CTRB_PT_TYPE_CD,49,8,3004572,44814721,4155146,,
CTRB_PT_TYPE_CD,49,9,3004572,44814721,4155146,,
CTRB_PT_TYPE_CD,49,10,3004572,44814721,4155146,,
"""

# Drinking items as answered from 2009 on; same columns.
OBSERVATION_ITEMS_2009 = """
DRNK_HABIT_RSPS_CD,43,1,40771103,44818704,45881908,,0
DRNK_HABIT_RSPS_CD,43,2,40771103,44818704,45881908,,1
DRNK_HABIT_RSPS_CD,43,3,40771103,44818704,45881908,,2
DRNK_HABIT_RSPS_CD,43,4,40771103,44818704,45881908,,3
DRNK_HABIT_RSPS_CD,43,5,40771103,44818704,45881908,,4
DRNK_HABIT_RSPS_CD,43,6,40771103,44818704,45881908,,5
DRNK_HABIT_RSPS_CD,43,7,40771103,44818704,45881908,,6
DRNK_HABIT_RSPS_CD,43,8,40771103,44818704,45881908,,7
TM1_DRKQTY_RSPS_CD,44,0,3037705,44818704,4045131,,
"""
# End of fixed values.


def _lines(text: str) -> list[str]:
    return text.strip().splitlines()


def seed_death_map(spark: SparkSession) -> DataFrame:
    rows = [line.split(",", 2) for line in _lines(DEATH_CAUSES)]
    return spark.createDataFrame(
        [(code, int(concept), name) for code, concept, name in rows],
        "source_code string, target_concept_id int, source_code_description string",
    )


def item_rows(text: str) -> list[tuple]:
    """(item, suffix, answer, concept, type, unit, value concept, value) with None for blanks."""
    out = []
    for line in _lines(text):
        item, suffix, answer, concept, kind, unit, value_concept, value = line.split(",")
        out.append(
            (
                item,
                suffix,
                int(answer),
                int(concept),
                int(kind),
                int(unit) if unit else None,
                int(value_concept) if value_concept else None,
                float(value) if value else None,
            )
        )
    return out


def _item_map(spark: SparkSession, text: str, prefix: str) -> DataFrame:
    return spark.createDataFrame(
        item_rows(text),
        f"meas_type string, id_value string, answer int, {prefix}_concept_id int, "
        f"{prefix}_type_concept_id int, {prefix}_unit_concept_id int, value_as_concept_id int, "
        "value_as_number double",
    )


def seed_measurement_map(spark: SparkSession) -> DataFrame:
    return _item_map(spark, MEASUREMENT_ITEMS, "measurement")


def seed_observation_map(spark: SparkSession) -> DataFrame:
    return _item_map(spark, OBSERVATION_ITEMS, "observation")


def seed_observation_map_2009(spark: SparkSession) -> DataFrame:
    return _item_map(spark, OBSERVATION_ITEMS_2009, "observation")


def seed_location(spark: SparkSession, path: str) -> DataFrame:
    """Region codes from a CSV file (code, province, district); see ``visits.location``.

    The national list has over 300 rows and changes with administrative reforms, so it is an
    input and not part of the library.
    """
    return spark.read.csv(
        path, schema="code string, province string, district string", header=True
    )
