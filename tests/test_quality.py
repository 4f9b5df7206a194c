import datetime as dt

from base_helpers import rows

from claimloom import schemas
from claimloom.operators import quality
from claimloom.sources import sinks


def test_metadata():
    assert len(schemas.CDM) == 27
    assert len(schemas.FOREIGN_KEYS) == 145
    assert schemas.PRIMARY_KEYS["death"] == ("person_id",)
    assert "cdm_source" not in schemas.PRIMARY_KEYS


def test_keys_and_nulls(spark):
    person = spark.createDataFrame(
        [(1, 8507, 1980, "x" * 51), (1, 8507, 1980, "y"), (2, None, 1980, None)],
        "person_id bigint, gender_concept_id int, year_of_birth int, person_source_value string",
    )
    death = spark.createDataFrame(
        [(1, dt.date(2008, 1, 1)), (3, dt.date(2008, 1, 1)), (3, dt.date(2008, 1, 1))],
        "person_id bigint, death_date date",
    )
    tables = {"person": person, "death": death}
    assert rows(quality.check_primary_keys(tables)) == [("death", 1, 2), ("person", 1, 2)]
    concept = spark.createDataFrame([(8507,)], "concept_id int")
    orphans = quality.check_foreign_keys(tables | {"concept": concept})
    assert rows(orphans) == [
        ("death", "person_id", "person", 1, 2), ("person", "gender_concept_id", "concept", 0, 0),
    ]
    nulls = {r[:3]: r[3] for r in rows(quality.check_not_null(tables))}
    assert nulls["person", "gender_concept_id", "null"] == 1
    assert nulls["person", "person_source_value", "length"] == 1
    assert nulls["death", "death_date", "null"] == 0


def test_parent_keys_are_not_gathered_on_the_driver(spark):
    person = spark.createDataFrame([(1,), (2,)], "person_id bigint")
    death = spark.createDataFrame([(1,), (3,), (3,)], "person_id bigint")
    found = quality.check_foreign_keys({"person": person, "death": death})
    assert rows(found) == [("death", "person_id", "person", 1, 2)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Broadcast" in line and "LeftAnti" in line]


def test_text_foreign_keys(spark):
    concept = spark.createDataFrame(
        [(1, "drug"), (2, "nothing")], "concept_id int, domain_id string"
    )
    domain = spark.createDataFrame([("drug", 1)], "domain_id string, domain_concept_id int")
    got = quality.check_foreign_keys({"concept": concept, "domain": domain})
    assert rows(got) == [
        ("concept", "domain_id", "domain", 1, 1), ("domain", "domain_concept_id", "concept", 0, 0),
    ]


def test_unique(spark):
    synonyms = spark.createDataFrame(
        [(1, "a", 5), (1, "a", 5), (1, "b", 5)],
        "concept_id int, concept_synonym_name string, language_concept_id int",
    )
    assert rows(quality.check_unique({"concept_synonym": synonyms})) == [("concept_synonym", 1, 2)]


def test_conform(spark):
    df = spark.createDataFrame([("7", 2.9, "abc")], "person_id string, quantity double, refills string")
    got = sinks.conform(df, "drug_exposure")
    assert got.columns == schemas.CDM["drug_exposure"].names
    assert rows(got, "person_id", "quantity", "refills") == [(7, 2.9, None)]
    device = sinks.conform(df, "device_exposure")
    assert rows(device, "quantity") == [(2,)]


def test_stage_counts(spark):
    got = sinks.stage_counts({"a": spark.range(3), "b": spark.range(0)})
    assert rows(got, "table_name", "rows") == [("a", 3), ("b", 0)]


def test_cdm_source(spark):
    concept = spark.createDataFrame(
        [("S", dt.date(2015, 6, 30)), ("S", dt.date(2099, 12, 31)), (None, dt.date(2019, 1, 1))],
        "standard_concept string, valid_end_date date",
    )
    got = sinks.cdm_source(spark, concept, dt.date(2020, 1, 1))
    assert rows(got, "vocabulary_version", "cdm_version") == [("2015-06-30", "v5.3.1")]
