"""Scalar rules on raw claim codes. Every function maps Columns to a Column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Form codes, arrival codes and concept ids the conversion must reproduce.
INPATIENT_FORMS = ("02", "2", "04", "06", "07", "10", "12")
OUTPATIENT_FORMS = ("03", "3", "05", "08", "8", "09", "9", "11", "13", "20", "21", "ZZ")
EMERGENCY_ARRIVALS = ("11", "21", "31")
DRUG_INPATIENT_FORMS = ("02", "2", "04", "06", "10", "12")

VISIT_INPATIENT, VISIT_OUTPATIENT, VISIT_EMERGENCY = 9201, 9202, 9203
VISIT_TYPE = 44818517
DRUG_TYPE_INPATIENT, DRUG_TYPE_OUTPATIENT = 38000180, 581452
PROCEDURE_TYPE = 45756900
DEVICE_TYPE = 44818705
DEATH_TYPE = 38003618
PERIOD_TYPE = 44814725
COST_TYPE, CURRENCY_WON = 5031, 44818598
RACE_KOREAN, ETHNICITY_NOT_HISPANIC = 38003585, 38003564

# (lowest institution type, highest institution type, place-of-service concept)
PLACES_OF_SERVICE = (
    ("10", "10", 4068130),
    ("20", "27", 4318944),
    ("28", "28", 82020103),
    ("29", "29", 4268912),
    ("30", "39", 82020105),
    ("40", "49", 82020106),
    ("50", "59", 82020107),
    ("60", "69", 82020108),
    ("70", "70", 82020109),
    ("71", "72", 82020110),
    ("73", "74", 82020111),
    ("75", "76", 82020112),
    ("77", "77", 82020113),
    ("80", "89", 4131032),
    ("91", "91", 82020115),
    ("92", "92", 82020116),
    ("93", "97", 82020117),
    ("98", "99", 82020118),
)
# (clause, item, route concept)
ROUTES = (
    ("03", "01", 4128794),
    ("03", "02", 45956875),
    ("04", "01", 4139962),
    ("04", "02", 4112421),
    ("04", "03", 4112421),
)
# Diagnosis position -> condition type concept; later positions share the last one.
CONDITION_TYPES = {1: 44786627, 2: 44786629, 3: 45756845, 4: 45756846}
CONDITION_TYPE_OTHER = 45756847
GENDERS = {1: 8507, 2: 8532}
# End of fixed values.

# try_cast reads '1d' as 1.0, so the text is checked first.
NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _first_match(cases: list[tuple[Column, object]], default: Column) -> Column:
    head, *rest = cases
    chain = reduce(lambda c, case: c.when(case[0], F.lit(case[1])), rest, F.when(head[0], F.lit(head[1])))
    return chain.otherwise(default)


def null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def number(text: Column) -> Column:
    """Numeric text as double; anything else is NULL."""
    text = text.cast("string")
    return F.when(text.rlike(NUMERIC_TEXT), F.trim(text).try_cast("double"))


def positive_or_one(text: Column) -> Column:
    """Dose arithmetic guard: missing, non-numeric or non-positive text counts as 1."""
    value = number(text)
    return F.when(value > 0, value).otherwise(F.lit(1.0))


def zero_pad(code: Column) -> Column:
    """``'3'`` -> ``'03'`` for the digits 1-9; other codes unchanged."""
    return F.when(code.rlike("^[1-9]$"), F.concat(F.lit("0"), code)).otherwise(code)


def two_digits(code: Column) -> Column:
    """Left-pad any one-character code with a zero."""
    return F.when(F.length(code) == 1, F.concat(F.lit("0"), code)).otherwise(code)


def ymd(text: Column) -> Column:
    """``yyyymmdd`` text as a date; text that is no date gives NULL, found by the NOT NULL check."""
    return F.try_to_date(text, "yyyyMMdd")


def first_day(year: Column) -> Column:
    return F.make_date(year.cast("int"), F.lit(1), F.lit(1))


def last_day(year: Column) -> Column:
    return F.make_date(year.cast("int"), F.lit(12), F.lit(31))


def place_of_service(institution_type: Column) -> Column:
    cases = [
        (institution_type == low if low == high else institution_type.between(low, high), concept)
        for low, high, concept in PLACES_OF_SERVICE
    ]
    return _first_match(cases, null("int"))


def visit_concept(form: Column, arrival: Column) -> Column:
    """An unknown arrival code satisfies neither IN nor NOT IN and falls to 0."""
    inpatient, outpatient = form.isin(*INPATIENT_FORMS), form.isin(*OUTPATIENT_FORMS)
    emergency = arrival.isin(*EMERGENCY_ARRIVALS)
    return _first_match(
        [
            ((inpatient | outpatient) & emergency, VISIT_EMERGENCY),
            (inpatient & ~emergency, VISIT_INPATIENT),
            (outpatient & ~emergency, VISIT_OUTPATIENT),
        ],
        F.lit(0),
    )


def visit_end(start: Column, form: Column, arrival: Column, days: Column) -> Column:
    """Stay length counts for inpatient and emergency claims; all others end the day they start."""
    stays = form.isin(*INPATIENT_FORMS) | (
        form.isin(*OUTPATIENT_FORMS) & arrival.isin(*EMERGENCY_ARRIVALS)
    )
    return F.when(stays & (days > 0), F.date_add(start, days.cast("int") - 1)).otherwise(start)


def route_concept(clause: Column, item: Column) -> Column:
    return _first_match([((clause == c) & (item == i), v) for c, i, v in ROUTES], F.lit(0))


def condition_type(position: Column) -> Column:
    return _first_match(
        [(position == n, v) for n, v in CONDITION_TYPES.items()], F.lit(CONDITION_TYPE_OTHER)
    )


def drug_type(form: Column) -> Column:
    """NULL form gives a NULL type."""
    return F.when(form.isin(*DRUG_INPATIENT_FORMS), DRUG_TYPE_INPATIENT).when(
        ~form.isin(*DRUG_INPATIENT_FORMS), DRUG_TYPE_OUTPATIENT
    )


def gender_concept(sex: Column) -> Column:
    return _first_match([(sex == n, v) for n, v in GENDERS.items()], null("int"))


def screening_id(master_seq: Column, item_suffix: Column) -> Column:
    """Master serial followed by the two-digit item suffix."""
    return F.concat(master_seq.cast("string"), item_suffix).cast("bigint")


def event_id(master_seq: Column, rank: Column) -> Column:
    """Master serial followed by the rank of the target; ranks above 9 run into the next serial."""
    return master_seq * 10 + rank


def decode_event_id(event: Column) -> Column:
    """Master serial of an event id, in integer arithmetic (a double loses digits above 2**53)."""
    return F.call_function("div", event, F.lit(10))


def payer_plan_id(person_id: Column, year: Column) -> Column:
    return F.concat(person_id.cast("string"), year.cast("string")).cast("bigint")
