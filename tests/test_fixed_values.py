"""Pins the fixed values that the plans and their oracles share."""

import hashlib

from claimloom.functions import codes
from claimloom.operators import screening
from claimloom.sources import seeds


def test_code_rules():
    assert codes.INPATIENT_FORMS == ("02", "2", "04", "06", "07", "10", "12")
    assert codes.OUTPATIENT_FORMS == (
        "03", "3", "05", "08", "8", "09", "9", "11", "13", "20", "21", "ZZ",
    )
    assert codes.EMERGENCY_ARRIVALS == ("11", "21", "31")
    assert codes.DRUG_INPATIENT_FORMS == ("02", "2", "04", "06", "10", "12")
    assert [concept for _, _, concept in codes.PLACES_OF_SERVICE] == [
        4068130, 4318944, 82020103, 4268912, 82020105, 82020106, 82020107, 82020108, 82020109,
        82020110, 82020111, 82020112, 82020113, 4131032, 82020115, 82020116, 82020117, 82020118,
    ]
    spans = [(int(low), int(high)) for low, high, _ in codes.PLACES_OF_SERVICE]
    assert spans[0] == (10, 10) and spans[-1] == (98, 99) and all(low <= high for low, high in spans)
    assert codes.ROUTES == (
        ("03", "01", 4128794), ("03", "02", 45956875), ("04", "01", 4139962),
        ("04", "02", 4112421), ("04", "03", 4112421),
    )


def test_screening_items_and_years():
    assert screening.EARLY_YEARS == tuple(str(y) for y in range(2002, 2009))
    assert screening.LATE_YEARS == tuple(str(y) for y in range(2009, 2014))
    assert [len(x) for x in (
        screening.NUMERIC_ITEMS, screening.CODED_ITEMS, screening.HISTORY_ITEMS,
        screening.FAMILY_ITEMS, screening.HABIT_ITEMS, screening.CONTINUOUS_ITEMS,
    )] == [16, 3, 10, 6, 4, 7]


def digest(text):
    return hashlib.sha256(text.strip().encode()).hexdigest()[:16]


def test_seed_texts_do_not_change_unnoticed():
    rows = {n: getattr(seeds, n).strip().splitlines() for n in (
        "DEATH_CAUSES", "MEASUREMENT_ITEMS", "OBSERVATION_ITEMS", "OBSERVATION_ITEMS_2009",
    )}
    assert {n: len(r) for n, r in rows.items()} == {
        "DEATH_CAUSES": 47, "MEASUREMENT_ITEMS": 34, "OBSERVATION_ITEMS": 89, "OBSERVATION_ITEMS_2009": 9,
    }
    assert {n: digest(getattr(seeds, n)) for n in rows} == DIGESTS


DIGESTS = {
    "DEATH_CAUSES": "b15bab1fdf9d754c",
    "MEASUREMENT_ITEMS": "1ffeebe16b5482a6",
    "OBSERVATION_ITEMS": "6c753416afe038b8",
    "OBSERVATION_ITEMS_2009": "8e95cb6e7fb0d3da",
}
