"""Tables that grow with the persons are joined without being gathered on the driver.

The tables of the tests are far below any broadcast size, so every join that leaves the choice to the
planner shows as a broadcast here.
"""

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.binding import increments
from claimloom.binding.queries import QUERIES
from claimloom.operators import keys
from claimloom.plans import increment

GROWING = ("person_id#", "key_seq#", "master_seq#", "_occurrence_id#", "_exposure_id#")


def _indent(line):
    return len(line) - len(line.lstrip(" :+-*()0123456789"))


def sent(df):
    """The broadcasts of a plan that hold persons, claims, lines or events."""
    lines, found = df._jdf.queryExecution().executedPlan().toString().splitlines(), []
    for i, line in enumerate(lines):
        if "BroadcastExchange" not in line:
            continue
        below = [line]
        for other in lines[i + 1 :]:
            if _indent(other) <= _indent(line):
                break
            below.append(other)
        if any(column in part for column in GROWING for part in below):
            found.append("\n".join(below))
    return found


@pytest.fixture
def written(monkeypatch):
    """All frames that are written."""
    kind, frames = type(keys.SparkSession.getActiveSession().range(0)), []
    write = kind.write

    def seen(self):
        frames.append(self)
        return write.fget(self)

    monkeypatch.setattr(kind, "write", property(seen))
    return frames


@pytest.mark.parametrize(
    "name",
    (
        "person", "observation_period", "condition_occurrence", "visit_occurrence", "observation",
        "measurement", "drug_exposure", "procedure_occurrence", "payer_plan_period", "cost",
        "cleanse_visit", "cleanse_payer_plan", "patch_person", "dq_outside_period",
        "dq_measurement_numeric", "check_not_null", "check_primary_keys", "check_foreign_keys", "conform_tables",
    ),
)
def test_queries_send_no_growing_table(stages, name):
    found = QUERIES[name].plan(stages)
    assert isinstance(found, DataFrame) and not sent(found)


def test_keyed_lines_send_no_claims(spark, stages, written, tmp_path):
    keyed = keys.keyed_lines(stages.t30, stages.t20, keys.TREATMENT, path=str(tmp_path / "keyed"))
    assert keyed.count() == stages.k30.count()
    assert written and not [plan for df in written for plan in sent(df)]


def test_ranks_within_groups_send_no_groups(spark):
    rows = spark.range(200).select(F.col("id") % 7, "id").toDF("person_id", "n")
    ranked = keys.ranked_within(rows, "person_id", ["n"], "place")
    assert not sent(ranked)
    assert ranked.where("place != floor(n / 7) + 1").isEmpty()


def test_loads_send_no_growing_table(spark, stages, written, tmp_path):
    """Both loads, of which the second meets what the first left."""
    store = increment.Store(spark, str(tmp_path / "store"), buckets=2)
    vocabulary = {
        "concept": stages.concept, "concept_relationship": stages.relationship, "concept_ancestor": stages.ancestor
    }
    for number, raw in enumerate(increments.loads(stages), 1):
        # The query's own way to the lines of a load.
        assert not [plan for name in increment.LINES for plan in sent(raw[name])]
        store.add(number, raw, vocabulary if number == 1 else None)
    assert len(written) > 30 and not [plan for df in written for plan in sent(df)]


def test_late_rows_send_no_eras(spark, stages):
    assert not sent(QUERIES["era_stream_late"].plan(stages))
