import datetime as dt
import os
import re

import pytest
from base_helpers import FOLDER, rows

from claimloom.binding.queries import QUERIES
from claimloom.operators import events
from claimloom.plans import dq, etl
from claimloom.sources import sinks

SAMPLE = (
    "person", "death", "observation_period", "care_site", "visit_occurrence_claims",
    "condition_occurrence", "drug_exposure", "procedure_dedup", "device_30t_ambiguous",
    "observation_categorical", "observation_income", "measurement_continuous", "payer_plan_period",
    "cost_drug_30t", "drug_era", "condition_era", "dose_era", "cleanse_condition",
    "check_primary_keys", "dq_procedure_raw_30t", "code_map", "seq_master",
)


def duck():
    import duckdb

    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        connection.sql(f"create view {name[:-8]} as select * from '{FOLDER}/{name}'")
    return connection


@pytest.mark.parametrize("name", SAMPLE)
def test_against_oracle(spark, name):
    query = QUERIES[name]
    got = query.run(spark, FOLDER)
    expected = duck().sql(query.oracle())
    assert got.columns == expected.columns
    assert rows(got) == sorted((tuple(r) for r in expected.fetchall()), key=repr)
    assert got.head() is not None


def test_every_query_has_an_oracle_and_typed_columns():
    for name, query in QUERIES.items():
        sql = query.oracle()
        assert sql and "{" not in re.sub(r"'[^']*'", "", sql), name
        assert {kind for _, kind in query.columns} <= {"bigint", "date", "string", "double"}, name


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "condition_occurrence", "drug_exposure", "procedure_occurrence", "device_exposure", "cost",
    "cleanse_drug", "dose_era", "drug_era", "observation_period", "dq_outside_period",
    "observation_continuous", "check_foreign_keys", "birth_year", "profile_table",
])
def test_no_nested_loops_and_no_python(spark, name):
    """Beyond the broadcast size every join still has an equality, and nothing leaves the JVM."""
    query = QUERIES[name]
    query.run(spark, FOLDER)  # stores the inputs
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(query.run(spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert "Python" not in text and "MapInPandas" not in text


def test_event_builders_need_no_shuffle(spark, stages):
    """Keyed lines carry header and serial: with a small map nothing is exchanged."""
    df = events.drug_lines(stages.k30, stages.code_map, False)
    assert "Exchange hashpartitioning" not in plan(df)
    device = plan(events.device_lines(stages.k30, stages.code_map, False))
    assert "Exchange hashpartitioning" not in device
    # Unused columns of the lines are not read.
    scan = next(part for part in device.split("\n") if "ReadSchema" in part and "div_cd" in part)
    assert "clause_cd" not in scan.split("ReadSchema")[1]


def test_filters_reach_the_scan(stages):
    text = plan(events.procedure_lines(stages.k30, stages.code_map, False, (events.UNMAPPED,)))
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(div_cd\)", text)
    seq = plan(stages.visit.where("visit_concept_id = 9201"))
    assert "EqualTo(visit_concept_id,9201)" in seq


@pytest.fixture(scope="module")
def inputs(stages):
    raw = {n: getattr(stages, n) for n in ("jk", "t20", "t30", "t40", "t60", "gj", "yk")}
    vocabulary = {
        "concept": stages.concept,
        "concept_relationship": stages.relationship,
        "concept_ancestor": stages.ancestor,
    }
    return raw, vocabulary


def test_pipeline_and_partial_rerun(spark, stages, inputs, tmp_path):
    out = str(tmp_path / "cdm")
    raw, vocabulary = inputs
    early = ("vocabulary", "master", "person", "death", "observation_period")
    etl.run_etl(spark, raw, vocabulary, out, stages=early)
    # The rest starts from the stored outputs of the first run.
    late = tuple(s for s in etl.CONVERSION if s not in early)
    tables = etl.run_etl(
        spark, raw, vocabulary, out, regions=stages.regions, today=dt.date(2020, 1, 1),
        overrides=stages.overrides, stages=late,
    )
    assert tables["condition_occurrence"].count() <= spark.read.parquet(
        f"{out}/condition_occurrence"
    ).count()
    stored = spark.read.parquet(f"{out}/drug_era")
    assert stored.count() == QUERIES["drug_era"].run(spark, FOLDER).count()
    assert stored.select("drug_era_id").distinct().count() == stored.count()
    assert tables["cost"].where("cost_domain_id = 'Visit'").count() == stages.t20.count()
    with pytest.raises(ValueError):
        etl.run_etl(spark, raw, vocabulary, out, stages=("nothing",))


def test_empty_tables_and_constraints(spark, inputs, tmp_path):
    out = str(tmp_path / "cdm")
    raw, vocabulary = inputs
    stages = ("ddl", "vocabulary", "person", "death", "constraints")
    tables = etl.run_etl(spark, raw, vocabulary, out, stages=stages)
    assert spark.read.parquet(f"{out}/note").count() == 0
    assert spark.read.parquet(f"{out}/person").count() > 0
    log = {r[:2]: r[2] for r in rows(tables["stage_log"], "stage", "table_name", "rows")}
    assert log["person", "person"] == tables["person"].count()
    found = {r[:2]: r[2] for r in rows(tables["checks/foreign_keys"], "child_table", "child_column", "orphan_rows")}
    assert found["death", "person_id"] == 0
    assert found["person", "location_id"] == tables["person"].count()
    # Rerunning the layout stage keeps what is there.
    etl.run_etl(spark, raw, vocabulary, out, stages=("ddl",))
    assert spark.read.parquet(f"{out}/person").count() > 0


def test_missing_stage_output_is_named(spark, inputs, tmp_path):
    raw, vocabulary = inputs
    with pytest.raises(KeyError, match="person"):
        etl.run_etl(spark, raw, vocabulary, str(tmp_path / "no"), stages=("observation_period",))


def test_dq_domains(spark, stages):
    s = stages
    report = dq.run_dq(
        s.t30, s.t40, s.t60, s.gj, s.k30, s.k40, s.k60, s.code_map, s.measurement_map,
        ("condition_occurrence",),
    )
    assert {r[0] for r in rows(report, "domain")} == {"condition_occurrence"}


def test_bucketed_tables_join_without_shuffle(spark, stages):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spark.sql("drop table if exists bucketed_drug")
        spark.sql("drop table if exists bucketed_period")
        drug = sinks.write_bucketed(stages.drug, "bucketed_drug", 4)
        period = sinks.write_bucketed(stages.period, "bucketed_period", 4)
        joined = drug.join(period, "person_id")
        assert "Exchange hashpartitioning" not in plan(joined)
        assert joined.count() == stages.drug.join(stages.period, "person_id").count()
    finally:
        spark.sql("drop table if exists bucketed_drug")
        spark.sql("drop table if exists bucketed_period")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def scans(df, column):
    """Executed scans that read a column, reused exchanges counted once."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    return sum("FileScan" in line and column in line for line in final.split("\n"))


@pytest.mark.parametrize("name", ["dose_era_spans", "drug_era_spans"])
def test_eras_scan_exposures_once(spark, stages, name):
    from claimloom.operators import eras

    df = getattr(eras, name)(stages.drug, stages.ingredient_map)
    assert scans(df, "drug_exposure_start_date") == 1


def test_cleansing_shuffles_events_once(spark, stages):
    from claimloom.operators import cleanse

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(cleanse.cleanse_drug(stages.drug, stages.period))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange for the events and one for the periods.
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("FileScan") == 2


def test_a_declared_table_is_not_taken_for_a_built_one(spark, stages, tmp_path):
    raw = {n: getattr(stages, n) for n in ("jk", "t20", "t30", "t40", "t60", "gj", "yk")}
    vocabulary = {"concept": stages.concept, "concept_relationship": stages.relationship,
                  "concept_ancestor": stages.ancestor}
    with pytest.raises(KeyError, match="has not been run"):
        etl.run_etl(spark, raw, vocabulary, str(tmp_path / "cdm"), stages=("ddl", "vocabulary", "eras"))
    with pytest.raises(ValueError, match="regions"):
        etl.run_etl(spark, raw, vocabulary, str(tmp_path / "cdm"))


def test_measures_of_written_tables(spark, tmp_path):
    """Rows, missing keys and dates come from the write itself, also for tables without rows."""
    from pyspark.sql import Observation

    day = dt.date
    df = spark.createDataFrame(
        [(1, 7, day(2005, 1, 1), day(2005, 1, 2), 1), (None, 7, day(2004, 3, 1), None, 1), (3, 7, None, None, 1)],
        "observation_period_id long, person_id long, observation_period_start_date date, "
        "observation_period_end_date date, period_type_concept_id int",
    )
    seen = Observation("rows")
    sinks.write_cdm(df.repartition(3), "observation_period", str(tmp_path), seen)
    assert seen.get == {
        "rows": 3, "null_keys": 1, "first_date": day(2004, 3, 1), "last_date": day(2005, 1, 1)
    }
    none = Observation("none")
    sinks.write_cdm(df.limit(0), "observation_period", str(tmp_path), none)
    assert none.get == {"rows": 0, "null_keys": 0, "first_date": None, "last_date": None}


def test_measures_need_no_second_read(spark, stages, inputs, tmp_path, monkeypatch):
    """No table is counted after it was written."""
    from pyspark.sql.classic.dataframe import DataFrame

    counted, plain = [], DataFrame.count
    monkeypatch.setattr(DataFrame, "count", lambda self: counted.append(self) or plain(self))
    raw, vocabulary = inputs
    tables = etl.run_etl(spark, raw, vocabulary, str(tmp_path / "cdm"), stages=("vocabulary", "person", "death"))
    assert not counted
    log = {r[0]: r[1:] for r in rows(tables["stage_log"], "table_name", "rows", "null_keys")}
    assert log["person"] == (plain(tables["person"]), 0)
    assert set(log) == {"source_to_concept_map", "code_map", "ingredient_map", "person", "death"}
