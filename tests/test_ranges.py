import datetime as dt
import random

from base_helpers import rows
from pyspark.sql import functions as F

from claimloom.operators import cleanse, ranges

BASE, DAY = dt.date(2003, 11, 1), dt.timedelta(days=1)
PERIODS = "person_id int, observation_period_start_date date, observation_period_end_date date"
EVENTS = "id int, person_id int, visit_start_date date, visit_end_date date"


def _data(seed, persons=5, events=400):
    """Periods that overlap, end before they begin or lack a date; events of all kinds, null ends."""
    rng = random.Random(seed)
    day = lambda: BASE + rng.randrange(1500) * DAY
    periods = []
    for person in range(persons):
        for _ in range(rng.randrange(4)):
            start = day()
            end = rng.choice([start + rng.randrange(700) * DAY, start, start - 5 * DAY, None])
            periods.append((person, rng.choice([start, start, start, None]), end))
    found = []
    for i in range(events):
        start = day()
        end = rng.choice([start, start + rng.randrange(40) * DAY, start - rng.randrange(600) * DAY, None])
        found.append((i, rng.choice([*range(persons), None]), rng.choice([start] * 9 + [None]), end))
    return periods, found


def _fits(event, period):
    _, person, start, end = event
    return None not in (person, start, end, *period) and (
        person == period[0] and start >= period[1] and end <= period[2]
    )


def test_semi_join_against_all_pairs(spark):
    for seed in range(4):
        periods, events = _data(seed)
        kept = cleanse.cleanse_visit(
            spark.createDataFrame(events, EVENTS), spark.createDataFrame(periods, PERIODS)
        )
        expected = [e for e in events if any(_fits(e, p) for p in periods)]
        assert rows(kept) == sorted(expected, key=repr) and kept.columns == ["id", "person_id", "visit_start_date", "visit_end_date"]
        # Some of them end before they begin.
        assert any(e[3] < e[2] for e in expected)


def test_join_gives_each_pair_once(spark):
    for seed in range(4):
        periods, events = _data(seed)
        found = ranges.with_period(
            spark.createDataFrame(events, EVENTS), spark.createDataFrame(periods, PERIODS), F.col("visit_start_date")
        )
        expected = [
            (e[0], p[1], p[2]) for e in events for p in periods if _fits((*e[:3], e[2]), p)
        ]
        assert rows(found, "id", ranges.FIRST, ranges.LAST) == sorted(expected, key=repr)


def test_one_hot_person_forms_no_product(spark):
    """2,000 periods and 40,000 visits of one person: compared are those of a year only."""
    n = 40_000
    start = F.date_add(F.lit(BASE), (F.col("id") % 20_000).cast("int"))
    events = spark.range(n).select("id", F.when(F.col("id") >= 0, 1).otherwise(2).alias("person_id"), start.alias("visit_start_date"), start.alias("visit_end_date"))
    first = F.date_add(F.lit(BASE), (F.col("id") * 10).cast("int"))
    periods = spark.range(2_000).select(F.when(F.col("id") >= 0, 1).otherwise(2).alias("person_id"), first.alias(ranges.FIRST), F.date_add(first, 4).alias(ranges.LAST))
    binned = events.groupBy(ranges.row_bin(F.col("visit_start_date"), F.col("visit_end_date")).alias("b")).count()
    spans = ranges.binned_periods(periods).groupBy("_bin").agg(F.count("*").alias("periods"))
    pairs = binned.join(spans, F.col("b") == F.col("_bin")).agg(F.sum(F.col("count") * F.col("periods"))).first()[0]
    assert pairs < n * 2_000 / 40
    assert cleanse.cleanse_visit(events, periods).count() == n // 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = cleanse.cleanse_visit(events, periods)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(person_id") == 1 and "_row_bin" in plan
