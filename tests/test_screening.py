from base_helpers import rows
from pyspark.sql import functions as F

from claimloom.operators import screening
from claimloom.sources import seeds


def screenings(spark, values):
    """values: (year, person, {item: text}); other items are NULL."""
    columns = [i.lower() for i in screening.GJ_ITEMS]
    data = [
        (year, person, "10", *[items.get(i) for i in screening.GJ_ITEMS])
        for year, person, items in values
    ]
    schema = "hchk_year string, person_id bigint, ykiho_gubun_cd string, " + ", ".join(
        f"{c} string" for c in columns
    )
    return spark.createDataFrame(data, schema)


def serials(spark, values):
    return spark.createDataFrame(
        [(800000000001 + i, "GJT", p, y) for i, (y, p) in enumerate(values)],
        "master_seq bigint, source_table string, person_id bigint, hchk_year string",
    )


def test_items():
    assert len(screening.GJ_ITEMS) == 48
    assert len(seeds.item_rows(seeds.MEASUREMENT_ITEMS)) == 34
    assert len(seeds.item_rows(seeds.OBSERVATION_ITEMS)) == 89
    assert len(seeds.item_rows(seeds.OBSERVATION_ITEMS_2009)) == 9
    assert len(seeds.DEATH_CAUSES.split()) > 47 and len(seeds.DEATH_CAUSES.strip().splitlines()) == 47


def test_categorical(spark):
    gj = screenings(spark, [
        ("2008", 1, {"FMLY_HPRTS_PATIEN_YN": "1", "DRNK_HABIT_RSPS_CD": "2", "HCHK_PMH_CD1": ""}),
        ("2009", 1, {"FMLY_HPRTS_PATIEN_YN": "1", "DRNK_HABIT_RSPS_CD": "2", "SMK_TERM_RSPS_CD": "3"}),
    ])
    seq = serials(spark, [("2008", 1), ("2009", 1)])
    got = screening.observation_categorical(gj, seq, seeds.seed_observation_map(spark))
    assert rows(
        got, "observation_id", "observation_concept_id", "value_as_number", "unit_concept_id",
        "observation_source_value",
    ) == [
        (80000000000131, 4053372, 0.0, None, "0"),
        (80000000000143, 40771103, 2.0, None, "2"),
        (80000000000231, 4050816, 1.0, None, "1"),
        (80000000000237, 40766364, 15.0, None, "3"),
    ]


def test_text_comparison(spark):
    gj = screenings(spark, [("2008", 1, {"HEIGHT": "170", "WEIGHT": "-5", "WAIST": "", "BLDS": "x"})])
    seq = serials(spark, [("2008", 1)])
    got = screening.measurement_continuous(gj, seq, seeds.seed_measurement_map(spark))
    # A letter sorts after '0' and passes like a digit; '-' sorts before it.
    assert rows(got, "measurement_id", "value_source_value") == [
        (80000000000101, "170"), (80000000000106, "x"),
    ]
    filled = screening.measurement_fill_value(got)
    assert rows(filled, "value_as_number") == [(170.0,), (None,)]


def test_drinking_2009(spark):
    gj = screenings(spark, [("2010", 1, {"DRNK_HABIT_RSPS_CD": "3", "TM1_DRKQTY_RSPS_CD": "7"})])
    seq = serials(spark, [("2010", 1)])
    items = seeds.seed_observation_map_2009(spark)
    habit = screening.observation_drink_2009_habit(gj, seq, items)
    assert rows(habit, "value_as_number", "unit_concept_id") == [(2.0, 45881908)]
    quantity = screening.observation_drink_2009_quantity(gj, seq, items)
    assert rows(quantity, "value_as_number", "unit_concept_id") == [(7.0, 4045131)]


def test_duplicate_screenings_fan_out(spark):
    gj = screenings(spark, [("2008", 1, {"GLY_CD": "1"}), ("2008", 1, {"GLY_CD": "7"})])
    seq = serials(spark, [("2008", 1)])
    got = screening.measurement_categorical(gj, seq, seeds.seed_measurement_map(spark))
    assert rows(got, "value_as_concept_id") == [(9189,)]


def test_vertical_drops_null_only(spark):
    gj = screenings(spark, [("2008", 1, {"GLY_CD": "", "HMG": "12"})])
    assert rows(screening.gj_vertical(gj), "meas_type", "meas_value") == [("GLY_CD", ""), ("HMG", "12")]


def test_income(spark):
    jk = spark.createDataFrame(
        [(1, 2008, "10"), (2, 2008, "11"), (3, 2008, ""), (4, 2008, "05")],
        "person_id bigint, stnd_y int, ctrb_pt_type_cd string",
    )
    seq = spark.createDataFrame(
        [(900000000000 + p, "JKT", p, "2008") for p in range(1, 5)],
        "master_seq bigint, source_table string, person_id bigint, stnd_y string",
    )
    got = screening.observation_income(jk, seq, seeds.seed_observation_map(spark))
    assert rows(got.withColumn("v", F.col("visit_occurrence_id").isNull()), "observation_id", "value_as_number", "v") == [
        (90000000000149, 10.0, True), (90000000000449, 5.0, True),
    ]
