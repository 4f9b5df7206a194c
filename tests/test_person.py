import datetime as dt

import pytest
from base_helpers import rows

from claimloom.operators import person

JK = (
    "person_id bigint, stnd_y int, sex int, age_group int, sgg string, dth_ym string, "
    "dth_code1 string"
)


def eligibility(spark, data):
    """data: person -> list of (year, band)."""
    return spark.createDataFrame(
        [(p, y, 1, g, "11110", "", "") for p, years in data.items() for y, g in years], JK
    )


# (rule, years and bands, birth year)
RULES = [
    ("1", [(2005, 3)] + [(y, 4) for y in range(2006, 2011)], [1991]),
    ("2", [(2005, 0), (2006, 1), (2007, 1)], [2005]),
    ("3-1", [(2005, 3), (2006, 3), (2007, 4), (2008, 4)], [1992]),
    ("3-2", [(2005, 3), (2008, 4)], [1995]),
    ("4", [(y, 17) for y in range(2002, 2008)] + [(2008, 18)], [1922]),
    ("5", [(y, 4) for y in range(2006, 2011)], [1991]),
    ("6", [(2009, 0)], [2009]),
    ("7", [(2009, 2), (2010, 2)], [2004]),
    ("8", [(y, 18) for y in range(2003, 2010)], [1918]),
]


@pytest.mark.parametrize("rule,years,expected", RULES, ids=[r[0] for r in RULES])
def test_birth_year_rules(spark, rule, years, expected):
    got = rows(person.birth_year(eligibility(spark, {1: years})), "rule", "year_of_birth")
    assert got == [(rule, y) for y in expected]


def test_birth_year_quirks(spark):
    data = {
        # rule 1 on the newborn band: year + 5
        1: [(y, 0) for y in range(2004, 2009)] + [(2009, 1)],
        # rule 4 with two long bands gives two rows
        2: [(y, 3) for y in range(1990, 1996)] + [(y, 4) for y in range(1996, 2002)],
        # a repeated row of the chosen year repeats the person
        3: [(2009, 2), (2009, 2)],
        # two bands that both continue in the same year count that year once
        4: [(2005, 2), (2006, 3), (2005, 6), (2006, 7)],
    }
    got = rows(person.birth_year(eligibility(spark, data)), "person_id", "year_of_birth")
    assert got == [
        (1, 2009), (2, 1980), (2, 1981), (3, 2004), (3, 2004), (4, 1976), (4, 1996),
    ]


def test_copies_collapse_before_the_person_window(spark):
    data = {1: [(2008, 2)] * 400 + [(2009, 2)], 2: [(2009, 3)]}
    latest = person.person_latest(eligibility(spark, data))
    assert rows(latest, "person_id") == [(1,), (2,)]
    births = person.birth_year(eligibility(spark, data))
    assert births.where("person_id = 1").count() == 400


def test_death(spark):
    jk = spark.createDataFrame(
        [
            (1, 2008, 1, 5, "1", "200802", "A00-A09"),
            (2, 2008, 1, 5, "1", "", "K1"),
            (3, 2008, 1, 5, "1", None, "K1"),
            (4, 2008, 1, 5, "1", "", ""),
            (5, 2008, 1, 5, "1", "200812", "unknown"),
        ],
        JK,
    )
    code_map = spark.createDataFrame(
        [("condition", "K1", 7, 1), ("condition", "K1", 8, 2), ("drug", "unknown", 9, 1)],
        "use string, source_code string, target_concept_id int, rn int",
    )
    seeds = spark.createDataFrame([("A00-A09", 4134887)], "source_code string, target_concept_id int")
    got = rows(person.death(jk, code_map, seeds), "person_id", "death_date", "cause_concept_id")
    assert got == sorted(
        [
            (1, dt.date(2008, 2, 29), 4134887),
            (2, dt.date(2008, 12, 31), 7),
            (2, dt.date(2008, 12, 31), 8),
            (5, dt.date(2008, 12, 31), None),
        ],
        key=repr,
    )


def test_observation_period(spark):
    jk = eligibility(spark, {1: [(2004, 1), (2005, 1), (2005, 1), (2007, 1)], 2: [(2005, 0), (2006, 0)]})
    persons = spark.createDataFrame([(1, 1980), (2, 2006)], "person_id bigint, year_of_birth int")
    deaths = spark.createDataFrame(
        [(1, dt.date(2007, 3, 31))], "person_id bigint, death_date date"
    )
    got = rows(
        person.observation_period(jk, persons, deaths),
        "person_id", "observation_period_start_date", "observation_period_end_date",
    )
    assert got == [
        (1, dt.date(2004, 1, 1), dt.date(2005, 12, 31)),
        (1, dt.date(2007, 1, 1), dt.date(2007, 3, 31)),
        (2, dt.date(2006, 1, 1), dt.date(2006, 12, 31)),
    ]


def test_periods_of_a_person_never_touch(stages):
    import pyspark.sql.functions as F
    from pyspark.sql import Window

    ordered = Window.partitionBy("person_id").orderBy("observation_period_start_date")
    gap = F.datediff(
        "observation_period_start_date", F.lag("observation_period_end_date").over(ordered)
    )
    assert stages.period.withColumn("gap", gap).where("gap <= 1").count() == 0
