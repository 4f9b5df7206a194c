import datetime as dt
import random
from collections import defaultdict

import pytest
from base_helpers import rows

from claimloom.operators import eras, vocab

DAY = dt.timedelta(days=1)
BASE = dt.date(2005, 1, 1)


def merged_ends(spans):
    """Ends of the merged spans of one group, by brute force over days covered + 30."""
    ends, latest = [], None
    for start, end in sorted(spans):
        if latest is not None and (start - latest).days > 30:
            ends.append(latest)
            latest = None
        latest = end if latest is None else max(latest, end)
    return ends + [latest]


def exposures(seed, people=4, count=300):
    rng = random.Random(seed)
    out = []
    for i in range(count):
        start = BASE + rng.randrange(1500) * DAY
        person = 1 if rng.random() < 0.5 else rng.randrange(2, people + 2)
        out.append(
            (i, person, rng.choice([100, 101]), start, start + rng.randrange(25) * DAY,
             rng.choice([38000180, 581452]), float(rng.choice([1, 2, 3])), 1)
        )
    return out


SCHEMA = (
    "drug_exposure_id bigint, person_id bigint, drug_concept_id int, drug_exposure_start_date date, "
    "drug_exposure_end_date date, drug_type_concept_id int, quantity double, days_supply int"
)


def vocabulary(spark):
    ancestor = spark.createDataFrame(
        [(1, 100), (2, 101), (1, 101), (3, 100), (100, 100)],
        "ancestor_concept_id int, descendant_concept_id int",
    )
    concept = spark.createDataFrame(
        [(1, "RxNorm", "Ingredient"), (2, "RxNorm Extension", "Ingredient"), (3, "ATC", "Ingredient"),
         (100, "RxNorm", "Clinical Drug")],
        "concept_id int, vocabulary_id string, concept_class_id string",
    )
    return vocab.ingredient_map(ancestor, concept)


INGREDIENTS = {100: [1], 101: [1, 2]}


def test_drug_era_against_brute_force(spark):
    data = exposures(3)
    groups = defaultdict(list)
    for _, p, c, s, e, kind, _, _ in data:
        for ingredient in INGREDIENTS[c]:
            groups[p, ingredient].append((s, e, kind))
    expected = []
    for (p, ingredient), spans in groups.items():
        ends = merged_ends([(s, e) for s, e, _ in spans])
        starts = defaultdict(set)
        for s, _, kind in spans:
            starts[kind, min(x for x in ends if x >= s)].add(s)
        expected += [
            (p, ingredient, min(days), end, len(days), 30) for (_, end), days in starts.items()
        ]
    got = rows(eras.drug_era_spans(spark.createDataFrame(data, SCHEMA), vocabulary(spark)))
    assert got == sorted(expected, key=repr)


def test_dose_era_takes_the_end_of_any_dose(spark):
    data = exposures(5)
    groups = defaultdict(list)
    for _, p, c, s, e, _, dose, _ in data:
        for ingredient in INGREDIENTS[c]:
            groups[p, ingredient].append((dose, s, e))
    expected = []
    for (p, ingredient), spans in groups.items():
        ends = [
            end
            for dose in {d for d, _, _ in spans}
            for end in merged_ends([(s, e) for d, s, e in spans if d == dose])
        ]
        starts = defaultdict(list)
        for dose, s, _ in spans:
            starts[dose, min(x for x in ends if x >= s)].append(s)
        expected += [(p, ingredient, dose, min(v), end) for (dose, end), v in starts.items()]
    got = rows(eras.dose_era_spans(spark.createDataFrame(data, SCHEMA), vocabulary(spark)))
    assert got == sorted(expected, key=repr)


def test_condition_era_gap_and_missing_end(spark):
    def day(n):
        return BASE + n * DAY

    data = [
        (1, 0, day(0), day(0)), (1, 0, day(30), day(40)), (1, 0, day(71), day(71)),
        (1, 0, day(71), day(72)), (2, 5, day(3), None),
    ]
    df = spark.createDataFrame(
        data,
        "person_id bigint, condition_concept_id int, condition_start_date date, "
        "condition_end_date date",
    )
    assert rows(eras.condition_era_spans(df)) == [
        (1, 0, day(0), day(40), 2), (1, 0, day(71), day(72), 1), (2, 5, day(3), day(4), 1),
    ]


def test_no_more_eras_than_events(stages):
    assert eras.condition_era_spans(stages.condition).count() <= stages.condition.count()


def _one_window(days, group):
    """Islands of whole groups, each sorted in one task, by kind."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    whole = Window.partitionBy(*group, "island")
    return (
        eras.islands(days, group)
        .withColumn("island_start", F.min("start").over(whole))
        .withColumn("island_end", F.max("end").over(whole))
        .groupBy(*group, "island_start", "island_end", "kind")
        .agg(F.min("start").alias("first_start"), F.count("*").alias("starts"))
    )


def test_slices_of_any_width_give_the_same_islands(spark):
    """Ends that reach over many slices, gaps of exactly 30 and 31 days at their borders."""
    rng = random.Random(5)
    data = {}
    for _ in range(1500):
        start = BASE + rng.randrange(4000) * DAY
        key = (rng.randrange(6), rng.choice([1, 2, None]), start)
        long = rng.choice([0, 0, 1, 25, 30, 31, 800 if rng.random() < 0.1 else 3])
        data[key] = max(data.get(key, start), start + long * DAY)
    for k in range(40):
        data[(9, 1, BASE + 31 * k * DAY)] = BASE + (31 * k + k % 2) * DAY
    days = spark.createDataFrame([(*k, e) for k, e in data.items()], "person_id int, kind int, start date, end date")
    columns = ["person_id", "kind", "first_start", "starts", "island_start", "island_end"]
    expected = rows(_one_window(days, ["person_id"]), *columns)
    for width in (1, 7, 31, 366, 10**6):
        assert rows(eras.sliced_islands(days, ["person_id"], width), *columns) == expected


def test_a_group_of_a_million_rows_is_spread_over_tasks(spark):
    """One person has a million days and kinds; its largest task is no larger than the others."""
    from pyspark.sql import functions as F

    n = 1_000_000
    day = (F.col("id") % 20_000).cast("int")
    hot = spark.range(n).select(
        F.lit(1).alias("person_id"), (F.col("id") / 20_000).cast("int").alias("kind"),
        F.date_add(F.lit(dt.date(1960, 1, 1)), F.when(day % 100 < 60, day).otherwise(day - day % 100)).alias("start"),
    )
    days = hot.groupBy("person_id", "kind", "start").agg(F.date_add("start", 1).alias("end"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sliced = days.withColumn("slice", F.floor(F.unix_date("start") / eras.SLICE_DAYS))
        local = eras.islands(sliced, ["person_id", "slice"])
        sizes = [r.n for r in local.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        total = days.count()
        assert sum(sizes) == total and len(sizes) >= 10 and max(sizes) < total / 4
        found = eras.sliced_islands(days, ["person_id"])
        # Of each hundred days the last 40 are free.
        assert found.count() == 200 * 50
        assert found.agg(F.sum("starts")).first()[0] == total
        assert rows(found.select("person_id", "island_start", "island_end").distinct()) == rows(
            _one_window(days, ["person_id"]).select("person_id", "island_start", "island_end").distinct()
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "2")


@pytest.mark.parametrize("name", ["drug_era_spans", "dose_era_spans", "condition_era_spans"])
def test_eras_move_twice(spark, stages, name):
    """Exposures to their day, days to their range; islands and the order of ids need no more."""
    from claimloom.operators import keys

    inputs = (stages.condition,) if name == "condition_era_spans" else (stages.drug, stages.ingredient_map)
    spans = getattr(eras, name)(*inputs)
    group, order = {
        "drug_era_spans": (eras.DRUG_GROUP, eras.DRUG_ERA_ORDER),
        "dose_era_spans": (eras.DRUG_GROUP, eras.DOSE_ERA_ORDER),
        "condition_era_spans": (eras.CONDITION_GROUP, eras.CONDITION_ERA_ORDER),
    }[name]
    plan = spans.sortWithinPartitions(*order)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange rangepartitioning") == 1
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = keys.with_identity(spans, order, "n", ranged=group)
        assert rows(found) == rows(keys.with_identity(spans, order, "n"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
