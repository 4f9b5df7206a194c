"""Observations and measurements from yearly health screenings and eligibility rows.

The serial is joined to the wide screening row and only the items a target needs are
unpivoted, so the shuffle carries one row per screening and not one per item.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes, packing
from .keys import unsent
from .visits import screening_master

# Screening items by the rule that converts them.
NUMERIC_ITEMS = (
    "HEIGHT", "WEIGHT", "WAIST", "BP_HIGH", "BP_LWST", "BLDS", "TOT_CHOLE", "TRIGLYCERIDE",
    "HDL_CHOLE", "LDL_CHOLE", "HMG", "OLIG_PH", "CREATININE", "SGOT_AST", "SGPT_ALT", "GAMMA_GTP",
)
CODED_ITEMS = ("GLY_CD", "OLIG_OCCU_CD", "OLIG_PROTE_CD")
HISTORY_ITEMS = (
    "HCHK_PMH_CD1", "HCHK_PMH_CD2", "HCHK_PMH_CD3", "HCHK_APOP_PMH_YN", "HCHK_HDISE_PMH_YN",
    "HCHK_HPRTS_PMH_YN", "HCHK_DIABML_PMH_YN", "HCHK_HPLPDM_PMH_YN", "HCHK_ETCDSE_PMH_YN",
    "HCHK_PHSS_PMH_YN",
)
FAMILY_ITEMS = (
    "FMLY_LIVER_DISE_PATIEN_YN", "FMLY_HPRTS_PATIEN_YN", "FMLY_APOP_PATIEN_YN",
    "FMLY_HDISE_PATIEN_YN", "FMLY_DIABML_PATIEN_YN", "FMLY_CANCER_PATIEN_YN",
)
HABIT_ITEMS = ("SMK_STAT_TYPE_RSPS_CD", "SMK_TERM_RSPS_CD", "DSQTY_RSPS_CD", "EXERCI_FREQ_RSPS_CD")
DRINK_HABIT, DRINK_QUANTITY = "DRNK_HABIT_RSPS_CD", "TM1_DRKQTY_RSPS_CD"
CONTINUOUS_ITEMS = (
    "CUR_SMK_TERM_RSPS_CD", "CUR_DSQTY_RSPS_CD", "PAST_SMK_TERM_RSPS_CD", "PAST_DSQTY_RSPS_CD",
    "MOV20_WEK_FREQ_ID", "MOV30_WEK_FREQ_ID", "WLK30_WEK_FREQ_ID",
)
INCOME_ITEM, DISABILITY_ITEM = "CTRB_PT_TYPE_CD", "DFAB_GRD_CD"
EARLY_YEARS = ("2002", "2003", "2004", "2005", "2006", "2007", "2008")
#: Drinking answers are converted for these years only; pass longer lists for newer screenings.
LATE_YEARS = ("2009", "2010", "2011", "2012", "2013")
# End of fixed values.

DRINK_ITEMS = (DRINK_HABIT, DRINK_QUANTITY)
CODED_ANSWERS = (*HISTORY_ITEMS, *FAMILY_ITEMS, *HABIT_ITEMS)
ANY_YEAR = ("0000", "9999")
GJ_ITEMS = (
    *NUMERIC_ITEMS, *CODED_ITEMS, *HISTORY_ITEMS, *FAMILY_ITEMS, *HABIT_ITEMS,
    *DRINK_ITEMS, *CONTINUOUS_ITEMS,
)


def _vertical(
    df: DataFrame, ids: list[str], items: tuple[str, ...], name: str, value: str
) -> DataFrame:
    wide = df.select(*ids, *[F.col(item.lower()).cast("string").alias(item) for item in items])
    # unpivot keeps NULL values, the SQL operator it replaces drops them.
    return wide.unpivot(ids, list(items), name, value).where(F.col(value).isNotNull())


def gj_vertical(gj: DataFrame, items: tuple[str, ...] = GJ_ITEMS) -> DataFrame:
    """One row per screening item with a value; all 48 items by default."""
    ids = [
        c
        for c in ("hchk_year", "person_id", "ykiho_gubun_cd", "master_seq")
        if c in gj.columns
    ]
    return _vertical(gj, ids, items, "meas_type", "meas_value")


def jk_vertical(jk: DataFrame) -> DataFrame:
    years = jk.withColumnRenamed("stnd_y", "hchk_year")
    return _vertical(
        years, ["hchk_year", "person_id"], (INCOME_ITEM, DISABILITY_ITEM), "jk_type", "jk_value"
    )


def _rules(
    items_map: DataFrame,
    prefix: str,
    items: tuple[str, ...],
    at_least: bool,
    years: tuple[str, ...] = ANY_YEAR,
    unit: bool = True,
) -> DataFrame:
    """Rows of a fixed item map with how, and in which years, an answer meets them."""
    unit_column = F.col(f"{prefix}_unit_concept_id") if unit else codes.null("int")
    return items_map.where(F.col("meas_type").isin(*items)).select(
        F.col("meas_type").alias("item"),
        "id_value",
        F.col("answer").cast("string").alias("answer"),
        F.col(f"{prefix}_concept_id").alias("item_concept_id"),
        F.col(f"{prefix}_type_concept_id").alias("item_type_concept_id"),
        unit_column.alias("unit_concept_id"),
        "value_as_concept_id",
        "value_as_number",
        F.lit(at_least).alias("at_least"),
        F.lit(years[0]).alias("first_year"),
        F.lit(years[-1]).alias("last_year"),
    )


def match_rules(answers: DataFrame, rules: DataFrame) -> DataFrame:
    """Join answers with the rules: under a hundred fixed rows, hence the broadcast.

    Values are compared as text. For "at least" rules any value that starts with a digit
    passes, '-5' does not.
    """
    value, answer = F.col("meas_value"), F.col("answer")
    met = F.when(F.col("at_least"), value >= answer).otherwise(value == answer)
    year = F.col("hchk_year").between(F.col("first_year"), F.col("last_year"))
    return answers.join(F.broadcast(rules), (F.col("meas_type") == F.col("item")) & year & met)


def _answers(gj: DataFrame, seq: DataFrame, items: tuple[str, ...]) -> DataFrame:
    columns = [i.lower() for i in items]
    # The answers are texts of a few characters and are converted as texts.
    rows = gj.select("hchk_year", "person_id", packing.packed(columns).alias("_answers"))
    serial = screening_master(rows, seq).withColumn("_texts", packing.parts(F.col("_answers")))
    wide = serial.select(
        "hchk_year", "person_id", "master_seq", *packing.unpacked(F.col("_texts"), columns)
    )
    return gj_vertical(wide, items).where(F.col("meas_value") != "")


def _observation(rows: DataFrame, value: str, visit: bool) -> DataFrame:
    number = F.coalesce(F.col("value_as_number"), codes.number(F.col(value)))
    return rows.select(
        codes.screening_id(F.col("master_seq"), F.col("id_value")).alias("observation_id"),
        "person_id",
        F.col("item_concept_id").alias("observation_concept_id"),
        codes.first_day(F.col("hchk_year")).alias("observation_date"),
        F.col("item_type_concept_id").alias("observation_type_concept_id"),
        number.alias("value_as_number"),
        "value_as_concept_id",
        "unit_concept_id",
        (F.col("master_seq") if visit else codes.null("bigint")).alias("visit_occurrence_id"),
        F.col(value).alias("observation_source_value"),
    )


def _screened(
    gj: DataFrame,
    seq: DataFrame,
    items: tuple[str, ...],
    rules: list[DataFrame],
    early_years: tuple[str, ...] = EARLY_YEARS,
) -> DataFrame:
    """Observations of the given items: one join with the serial, one unpivot, one rule join.

    Family history was answered 1/2 up to 2008 and 0/1 afterwards; early answers shift by one.
    """
    early = F.col("hchk_year").isin(*early_years)
    shifted = (F.col("meas_value").try_cast("int") - 1).cast("string")
    value = F.when(F.col("meas_type").isin(*FAMILY_ITEMS) & early, shifted).otherwise(
        F.col("meas_value")
    )
    answers = _answers(gj, seq, items)
    if set(items) & set(FAMILY_ITEMS):
        answers = answers.withColumn("meas_value", value)
    return _observation(match_rules(answers, reduce(DataFrame.unionByName, rules)), "meas_value", True)


def _categorical_rules(
    observation_map: DataFrame, early_years: tuple[str, ...] = EARLY_YEARS
) -> list[DataFrame]:
    """Coded answers. Drinking items count up to 2008; the unit is not carried over."""
    return [
        _rules(observation_map, "observation", CODED_ANSWERS, False, unit=False),
        _rules(observation_map, "observation", DRINK_ITEMS, False, early_years, unit=False),
    ]


def _continuous_rules(observation_map: DataFrame) -> list[DataFrame]:
    return [_rules(observation_map, "observation", CONTINUOUS_ITEMS, True)]


def _quantity_2009_rules(
    map_2009: DataFrame, late_years: tuple[str, ...] = LATE_YEARS
) -> list[DataFrame]:
    return [_rules(map_2009, "observation", (DRINK_QUANTITY,), True, late_years)]


def _habit_2009_rules(
    map_2009: DataFrame, late_years: tuple[str, ...] = LATE_YEARS
) -> list[DataFrame]:
    return [_rules(map_2009, "observation", (DRINK_HABIT,), False, late_years)]


def observation_categorical(
    gj: DataFrame,
    seq: DataFrame,
    observation_map: DataFrame,
    early_years: tuple[str, ...] = EARLY_YEARS,
) -> DataFrame:
    items = (*CODED_ANSWERS, *DRINK_ITEMS)
    return _screened(gj, seq, items, _categorical_rules(observation_map, early_years), early_years)


def observation_continuous(gj: DataFrame, seq: DataFrame, observation_map: DataFrame) -> DataFrame:
    return _screened(gj, seq, CONTINUOUS_ITEMS, _continuous_rules(observation_map))


def observation_drink_2009_quantity(
    gj: DataFrame, seq: DataFrame, map_2009: DataFrame, late_years: tuple[str, ...] = LATE_YEARS
) -> DataFrame:
    return _screened(gj, seq, (DRINK_QUANTITY,), _quantity_2009_rules(map_2009, late_years))


def observation_drink_2009_habit(
    gj: DataFrame, seq: DataFrame, map_2009: DataFrame, late_years: tuple[str, ...] = LATE_YEARS
) -> DataFrame:
    return _screened(gj, seq, (DRINK_HABIT,), _habit_2009_rules(map_2009, late_years))


def observation_income(jk: DataFrame, seq: DataFrame, observation_map: DataFrame) -> DataFrame:
    """Income decile of the eligibility row, matched as a number; carries no visit."""
    serial = seq.where(F.col("source_table") == "JKT").select("master_seq", "person_id", "stnd_y")
    rules = _rules(observation_map, "observation", (INCOME_ITEM,), False)
    rows = (
        jk.select(
            "person_id",
            F.col("stnd_y").cast("string").alias("stnd_y"),
            F.col(INCOME_ITEM.lower()).cast("string").alias("jk_value"),
        )
        .where(F.col("jk_value") != "")
        .join(unsent(serial), ["person_id", "stnd_y"])
        .join(
            F.broadcast(rules.withColumn("answer", F.col("answer").cast("int"))),
            F.col("jk_value").try_cast("int") == F.col("answer"),
        )
        .withColumnRenamed("stnd_y", "hchk_year")
    )
    return _observation(rows, "jk_value", False)


def observation(
    gj: DataFrame,
    jk: DataFrame,
    seq: DataFrame,
    observation_map: DataFrame,
    map_2009: DataFrame,
    early_years: tuple[str, ...] = EARLY_YEARS,
    late_years: tuple[str, ...] = LATE_YEARS,
) -> DataFrame:
    """All observations; the four screening branches share one pass over the screenings.

    ``early_years`` and ``late_years`` are consecutive years of the two questionnaires; drinking
    answers of other years are left out, as in the source system.
    """
    rules = [
        *_categorical_rules(observation_map, early_years),
        *_continuous_rules(observation_map),
        *_quantity_2009_rules(map_2009, late_years),
        *_habit_2009_rules(map_2009, late_years),
    ]
    items = (*CODED_ANSWERS, *DRINK_ITEMS, *CONTINUOUS_ITEMS)
    return _screened(gj, seq, items, rules, early_years).unionByName(
        observation_income(jk, seq, observation_map)
    )


def _measured(
    gj: DataFrame, seq: DataFrame, items: tuple[str, ...], rules: DataFrame
) -> DataFrame:
    return match_rules(_answers(gj, seq, items), rules).select(
        codes.screening_id(F.col("master_seq"), F.col("id_value")).alias("measurement_id"),
        "person_id",
        F.col("item_concept_id").alias("measurement_concept_id"),
        codes.first_day(F.col("hchk_year")).alias("measurement_date"),
        F.col("item_type_concept_id").alias("measurement_type_concept_id"),
        F.col("value_as_number").cast("double").alias("value_as_number"),
        "value_as_concept_id",
        "unit_concept_id",
        F.col("master_seq").alias("visit_occurrence_id"),
        F.col("meas_value").alias("measurement_source_value"),
        F.col("meas_value").alias("value_source_value"),
    )


def numeric_rules(measurement_map: DataFrame) -> DataFrame:
    return _rules(measurement_map, "measurement", NUMERIC_ITEMS, True)


def coded_rules(measurement_map: DataFrame) -> DataFrame:
    return _rules(measurement_map, "measurement", CODED_ITEMS, False)


def measurement_continuous(gj: DataFrame, seq: DataFrame, measurement_map: DataFrame) -> DataFrame:
    return _measured(gj, seq, NUMERIC_ITEMS, numeric_rules(measurement_map))


def measurement_categorical(gj: DataFrame, seq: DataFrame, measurement_map: DataFrame) -> DataFrame:
    return _measured(gj, seq, CODED_ITEMS, coded_rules(measurement_map))


def measurement(gj: DataFrame, seq: DataFrame, measurement_map: DataFrame) -> DataFrame:
    """value_as_number stays NULL as in the source system; see :func:`measurement_fill_value`."""
    rules = numeric_rules(measurement_map).unionByName(coded_rules(measurement_map))
    return _measured(gj, seq, (*NUMERIC_ITEMS, *CODED_ITEMS), rules)


def measurement_fill_value(measurements: DataFrame) -> DataFrame:
    """Optional step: take the number from the source value where it is numeric."""
    filled: Column = F.coalesce(
        F.col("value_as_number"), codes.number(F.col("measurement_source_value"))
    )
    return measurements.withColumn("value_as_number", filled)
