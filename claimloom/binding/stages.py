"""Stage outputs over the bound raw tables, as the conversion leaves them for later stages.

Stages share state through stored tables only. A query therefore builds its own result
from the stored outputs of earlier stages, and never reads a stored copy of that result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import eras, events, keys, money, person, screening, visits, vocab
from ..sources import seeds
from ..work import store
from . import raw

# stage -> how it is built from the stages before it
BUILD: dict[str, Callable[[Stages], DataFrame]] = {
    "source_map": lambda s: vocab.build_source_map(s.concept, s.relationship),
    "code_map": lambda s: vocab.code_map(s.source_map, s.concept),
    "ingredient_map": lambda s: vocab.ingredient_map(s.ancestor, s.concept),
    "person": lambda s: person.person(s.jk),
    "death": lambda s: person.death(s.jk, s.code_map, s.death_map),
    "period": lambda s: person.observation_period(s.jk, s.person, s.death),
    "visit": lambda s: visits.visit_occurrence(s.t20, s.gj, s.seq),
    "condition": lambda s: events.condition_occurrence(s.k40, s.period, s.code_map),
    "drug": lambda s: events.drug_exposure(s.k30, s.k60, s.death, s.code_map),
    "procedure": lambda s: events.procedure_occurrence(s.k30, s.k60, s.drug, s.code_map),
    "device": lambda s: events.device_exposure(s.k30, s.k60, s.code_map),
    "observation": lambda s: screening.observation(
        s.gj, s.jk, s.seq, s.observation_map, s.observation_map_2009
    ),
    "measurement": lambda s: screening.measurement(s.gj, s.seq, s.measurement_map),
    "payer": lambda s: money.payer_plan_period(s.jk, s.death),
    "care_site": lambda s: visits.care_site(s.yk),
    "location": lambda s: visits.location(s.regions),
}
# Stored for the integrity checks only: outputs that no later stage reads.
BUILD_LAST: dict[str, Callable[[Stages], DataFrame]] = {
    "numbered_period": lambda s: keys.with_identity(
        s.period, ["person_id", "observation_period_start_date"], "observation_period_id"
    ),
    "cost_rows": lambda s: money.cost(
        s.visit, s.drug, s.procedure, s.device, s.t20, s.k30, s.k60, s.code_map
    ),
    "drug_eras": lambda s: eras.drug_era(s.drug, s.ingredient_map),
    "condition_eras": lambda s: eras.condition_era(s.condition),
    "dose_eras": lambda s: eras.dose_era(s.drug, s.ingredient_map),
}
PARTITIONED = {"code_map": ("use",)}

_stored: dict[tuple[str, str, str], DataFrame] = {}


class Stages:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in BUILD or name in BUILD_LAST:
            key = (self.spark.sparkContext.applicationId, self.folder, name)
            if key not in _stored:
                built = (BUILD.get(name) or BUILD_LAST[name])(self)
                _stored[key] = store(built, f"stage-{name}", PARTITIONED.get(name, ()))
            return _stored[key]
        if name.startswith("_"):
            raise AttributeError(name)
        return raw.table(self.spark, self.folder, name)

    def fresh(self, name: str) -> DataFrame:
        """The plan of a stage over its stored inputs."""
        return BUILD[name](self)

    @cached_property
    def death_map(self) -> DataFrame:
        return seeds.seed_death_map(self.spark)

    @cached_property
    def measurement_map(self) -> DataFrame:
        return seeds.seed_measurement_map(self.spark)

    @cached_property
    def observation_map(self) -> DataFrame:
        return seeds.seed_observation_map(self.spark)

    @cached_property
    def observation_map_2009(self) -> DataFrame:
        return seeds.seed_observation_map_2009(self.spark)

    @cached_property
    def overrides(self) -> DataFrame:
        """Gender corrections for a few persons of the bound tables."""
        return (
            self.jk.where(F.col("person_id") % 101 == 7)
            .select(
                "person_id",
                F.lit(8507).alias("gender_concept_id"),
                F.lit("1").alias("gender_source_value"),
            )
            .distinct()
        )
