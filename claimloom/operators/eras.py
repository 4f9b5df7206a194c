"""Drug, condition and dose eras: exposures merged over gaps of up to 30 days.

An era is an island: a new one begins where a start lies more than 30 days after the latest
end so far. Counts are distinct starts, so exposures are first collapsed to one row per
start day (partial aggregation before the shuffle). A person-concept group then holds at
most one row per calendar day and drug type, however many exposures it had.

Drug and condition eras are found in two steps, so that no group has to fit a task: islands of a
time slice of a group, and islands of these, which are few: within a slice they are more than 30
days apart. Merging is associative: an island stands for its rows by its first start, its
last end and what it counts.

The collapsed days lie in ranges of person and concept, so both steps, and the ids of the eras in
their order, need no further shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keys import with_identity
from .vocab import ingredient_rollup

GAP_DAYS = 30
# Columns of the eras of which a group lies in one range of the spans below.
DRUG_GROUP, CONDITION_GROUP = ("person_id", "drug_concept_id"), ("person_id", "condition_concept_id")
# Days of a time slice: a task gets the rows of one slice of a group at a time.
SLICE_DAYS = 366

# Total orders in which eras get their ids.
DRUG_ERA_ORDER = [
    "person_id",
    "drug_concept_id",
    "drug_era_start_date",
    "drug_era_end_date",
    "drug_exposure_count",
]
CONDITION_ERA_ORDER = [
    "person_id",
    "condition_concept_id",
    "condition_era_start_date",
    "condition_era_end_date",
]
DOSE_ERA_ORDER = [
    "person_id",
    "drug_concept_id",
    "dose_value",
    "dose_era_start_date",
    "dose_era_end_date",
]


def islands(rows: DataFrame, group: list[str]) -> DataFrame:
    """Number the islands of each group over rows with columns start and end.

    Rows must be collapsed per start day first: the window then sorts at most one row per
    calendar day (and drug type) of a group. An end must not precede its start; the event
    builders see to that, and an exposure of another table that ends early counts for its day.
    """
    ordered = Window.partitionBy(*group).orderBy("start")
    latest = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.datediff(F.col("start"), latest) <= GAP_DAYS, 0).otherwise(1)
    number = F.sum("_opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("_opens", opens).withColumn("island", number).drop("_opens")


def sliced_islands(days: DataFrame, group: list[str], slice_days: int = SLICE_DAYS) -> DataFrame:
    """Islands of each group, in which no task sorts more than a time slice of a group.

    ``days`` has one row for each ``kind`` and start day of a group, with columns kind, start and
    end. Returns a row for each island and kind in it: the group, kind, first_start and starts
    (of the kind), island_start and island_end.
    """
    in_slice = [*group, "slice"]
    local = islands(
        days.withColumn("slice", F.floor(F.unix_date("start") / slice_days)), in_slice
    )
    kinds = local.groupBy(*in_slice, "island", "kind").agg(
        F.min("start").alias("first_start"), F.count("*").alias("starts"), F.max("end").alias("end")
    )
    parts = kinds.groupBy(*in_slice, "island").agg(
        F.min("first_start").alias("start"),
        F.max("end").alias("end"),
        F.collect_list(F.struct("kind", "first_start", "starts")).alias("kinds"),
    )
    joined = Window.partitionBy(*group, "island")
    return (
        islands(parts.drop("slice", "island"), group)
        .withColumn("island_start", F.min("start").over(joined))
        .withColumn("island_end", F.max("end").over(joined))
        .select(*group, "island_start", "island_end", F.inline("kinds"))
        .groupBy(*group, "island_start", "island_end", "kind")
        .agg(F.min("first_start").alias("first_start"), F.sum("starts").alias("starts"))
    )


def _exposure_span() -> tuple[Column, Column]:
    start = F.col("drug_exposure_start_date")
    end = F.coalesce(
        F.col("drug_exposure_end_date"),
        F.date_add(start, F.col("days_supply")),
        F.date_add(start, 1),
    )
    return start.alias("start"), F.greatest(start, end).alias("end")


def drug_era_spans(drug: DataFrame, ingredients: DataFrame) -> DataFrame:
    """Drug eras without ids. Islands ignore the drug type, the final grouping does not."""
    exposures = drug.select(
        "person_id", "drug_concept_id", "drug_type_concept_id", *_exposure_span()
    )
    group = ["person_id", "ingredient_concept_id"]
    days = (
        ingredient_rollup(exposures, ingredients)
        .withColumnRenamed("drug_type_concept_id", "kind")
        .groupBy(*group, "kind", "start")
        .agg(F.max("end").alias("end"))
        .repartitionByRange(*group)
    )
    return sliced_islands(days, group).select(
        "person_id",
        F.col("ingredient_concept_id").alias("drug_concept_id"),
        F.col("first_start").alias("drug_era_start_date"),
        F.col("island_end").alias("drug_era_end_date"),
        F.col("starts").alias("drug_exposure_count"),
        F.lit(GAP_DAYS).alias("gap_days"),
    )


def drug_era(drug: DataFrame, ingredients: DataFrame) -> DataFrame:
    spans = drug_era_spans(drug, ingredients)
    return with_identity(spans, DRUG_ERA_ORDER, "drug_era_id", ranged=DRUG_GROUP)


def condition_era_spans(condition: DataFrame) -> DataFrame:
    """Condition eras without ids; the unmapped concept 0 forms eras like any other."""
    start = F.col("condition_start_date")
    group = ["person_id", "condition_concept_id"]
    days = (
        condition.select(
            *group,
            start.alias("start"),
            F.greatest(start, F.coalesce("condition_end_date", F.date_add(start, 1))).alias("end"),
        )
        .groupBy(*group, "start")
        .agg(F.max("end").alias("end"))
        .repartitionByRange(*group)
    )
    one_kind = days.withColumn("kind", F.lit(None).cast("int"))
    return sliced_islands(one_kind, group).select(
        *group,
        F.col("island_start").alias("condition_era_start_date"),
        F.col("island_end").alias("condition_era_end_date"),
        F.col("starts").alias("condition_occurrence_count"),
    )


def condition_era(condition: DataFrame) -> DataFrame:
    spans = condition_era_spans(condition)
    return with_identity(spans, CONDITION_ERA_ORDER, "condition_era_id", ranged=CONDITION_GROUP)


def dose_era_spans(drug: DataFrame, ingredients: DataFrame) -> DataFrame:
    """Dose eras without ids, in one pass over the exposures.

    Islands are formed per dose, but an exposure ends at the earliest island end on or after
    its start over all doses of the person and ingredient, as in the source system. The
    lookup is no range join: the start days of a person and ingredient and one end for each
    island are put in date order, and each start takes the next end.
    """
    group = ["person_id", "ingredient_concept_id"]
    exposures = drug.select(
        "person_id", "drug_concept_id", F.col("quantity").alias("dose_value"), *_exposure_span()
    )
    days = (
        ingredient_rollup(exposures, ingredients)
        .groupBy(*group, "dose_value", "start")
        .agg(F.max("end").alias("end"))
        .repartitionByRange(*group)
    )
    island = Window.partitionBy(*group, "dose_value", "island")
    no_date = F.lit(None).cast("date")
    begins = F.struct(F.col("start").alias("at"), no_date.alias("era_end"))
    ends = F.struct(F.col("island_end").alias("at"), F.col("island_end").alias("era_end"))
    # The first day of an island stands for its end as well.
    events = (
        islands(days, [*group, "dose_value"])
        .withColumn("island_end", F.max("end").over(island))
        .withColumn("opened", F.min("start").over(island))
        .withColumn("event", F.array(begins, F.when(F.col("start") == F.col("opened"), ends)))
        .select(*group, "dose_value", F.explode(F.array_compact("event")).alias("event"))
        .select(*group, "dose_value", "event.*")
    )
    # Ends sort after starts of the same day, so an end on the start day counts.
    following = (
        Window.partitionBy(*group)
        .orderBy("at", F.col("era_end").asc_nulls_first())
        .rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    return (
        events.withColumn("dose_era_end_date", F.min("era_end").over(following))
        .where(F.col("era_end").isNull() & F.col("dose_era_end_date").isNotNull())
        .groupBy(*group, "dose_value", "dose_era_end_date")
        .agg(F.min("at").alias("dose_era_start_date"))
        .select(
            "person_id",
            F.col("ingredient_concept_id").alias("drug_concept_id"),
            "dose_value",
            "dose_era_start_date",
            "dose_era_end_date",
        )
    )


def dose_era(drug: DataFrame, ingredients: DataFrame) -> DataFrame:
    spans = dose_era_spans(drug, ingredients)
    return with_identity(spans, DOSE_ERA_ORDER, "dose_era_id", ranged=DRUG_GROUP)
