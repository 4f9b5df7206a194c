"""The whole conversion in stage order, each stage written and read back."""

from __future__ import annotations

import datetime as dt
import logging
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from .. import schemas
from ..operators import cleanse, eras, events, keys, money, person, quality, screening, visits, vocab
from ..sources import loader, seeds, sinks
from ..work import CODEC, fresh_path, remove, work_root

log = logging.getLogger(__name__)

STAGES = (
    "ddl",
    "vocabulary",
    "cdm_source",
    "master",
    "location",
    "care_site",
    "person",
    "death",
    "observation_period",
    "visit_occurrence",
    "condition_occurrence",
    "observation",
    "drug_exposure",
    "procedure_occurrence",
    "device_exposure",
    "measurement",
    "payer_plan_period",
    "cost",
    "eras",
    "dose_era",
    "indexing",
    "constraints",
    "data_cleansing",
)
# The conversion proper, without empty tables, bucketed copies and integrity reports.
CONVERSION = tuple(s for s in STAGES if s not in ("ddl", "indexing", "constraints"))
# Marks a table that was declared but not built yet, in its schema.
UNBUILT = "unbuilt"
SOURCES = {"t30": keys.TREATMENT, "t40": keys.DIAGNOSIS, "t60": keys.PRESCRIPTION}
CLEANSED = {
    "visit_occurrence": cleanse.cleanse_visit,
    "condition_occurrence": cleanse.cleanse_condition,
    "drug_exposure": cleanse.cleanse_drug,
    "procedure_occurrence": cleanse.cleanse_procedure,
    "device_exposure": cleanse.cleanse_device,
    "measurement": cleanse.cleanse_measurement,
    "payer_plan_period": cleanse.cleanse_payer_plan,
}


def scratch(spark: SparkSession) -> str:
    """A fresh output folder below the shared work folder."""
    return f"{work_root(spark)}/claimloom/etl-{uuid.uuid4().hex}"


class _Tables:
    """Stage outputs: those of this run, or the stored ones of an earlier run."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out, self.done = spark, out.rstrip("/"), {}
        # The columns that stages of this run filled; the others of a table are NULL.
        self.filled: dict[str, list[str]] = {}
        # Measures of the tables in the order they were written.
        self.written: list[tuple[str, Observation]] = []

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.done:
            try:
                self.done[name] = self.spark.read.parquet(f"{self.out}/{name}")
            except AnalysisException as error:
                raise KeyError(f"stage output {name} is neither built nor stored") from error
        if UNBUILT in self.done[name].schema[0].metadata:
            del self.done[name]
            raise KeyError(f"{name} is declared, but its stage has not been run")
        return self.done[name]

    def __contains__(self, name: str) -> bool:
        try:
            return self[name] is not None
        except KeyError:
            return False

    def declared(self, name: str) -> DataFrame | None:
        """The table, or the empty one of the layout stage; integrity reports take both."""
        if name in self:
            return self[name]
        try:
            return self.spark.read.parquet(f"{self.out}/{name}")
        except AnalysisException:
            return None

    def seen(self, name: str) -> Observation:
        self.written.append((name, Observation(f"{name}-{uuid.uuid4().hex}")))
        return self.written[-1][1]

    def write(self, name: str, df: DataFrame) -> None:
        self.done[name] = sinks.write_cdm(df, name, self.out, self.seen(name))
        self.filled[name] = [c for c in self.done[name].columns if c in df.columns]

    def write_identified(
        self, name: str, df: DataFrame, order: list[str], key: str, ranged: tuple[str, ...] = ()
    ) -> None:
        """Write with ids 1..n; the numbered copy in between is removed."""
        path = fresh_path(self.spark, key)
        self.write(name, keys.with_identity(df, order, key, path, ranged))
        remove(self.spark, path)

    def write_work(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        path = f"{self.out}/{name}"
        rows = sinks.observed(df, name, self.seen(name))
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path, compression=CODEC)
        self.done[name] = self.spark.read.schema(df.schema).parquet(path)


def run_etl(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    vocabulary: dict[str, DataFrame],
    out: str,
    regions: DataFrame | None = None,
    overrides: DataFrame | None = None,
    today: dt.date | None = None,
    stages: tuple[str, ...] = STAGES,
    ranges: keys.SerialRanges = keys.RANGES,
    early_years: tuple[str, ...] = screening.EARLY_YEARS,
    late_years: tuple[str, ...] = screening.LATE_YEARS,
    buckets: int = 64,
) -> dict[str, DataFrame]:
    """Run the chosen stages in order and return the stage outputs.

    ``raw`` holds jk, t20, t30, t40, t60, gj and yk, whose texts lose trailing blanks first;
    ``vocabulary`` holds concept, concept_relationship and concept_ancestor, normalised;
    ``regions`` are needed by the stage location. ``early_years`` and ``late_years`` are those of
    the two screening questionnaires. A stage that is not chosen is read from ``out`` where a
    later one needs it; ``stage_log`` of the result holds, for each table a stage wrote, its rows,
    rows without key, first and last date, gathered while it was written, and the stage's seconds.
    File order by person and concept is applied at each write; the stage indexing adds copies
    bucketed by person as catalog tables ``indexed_<table>``. Costs and eras see uncleansed
    events; cleansed tables go to ``<table>`` below ``out/cleansed``, so a rerun starts from
    unchanged inputs.
    """
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}")
    if "location" in stages and regions is None:
        raise ValueError("the stage location needs regions: persons and care sites refer to them")
    raw = {name: loader.normalise_strings(df) for name, df in raw.items()}
    chosen = [s for s in STAGES if s in stages]
    tables = _Tables(spark, out)
    concept = vocabulary["concept"]

    def create_tables():
        """Empty tables of the declared layout, for CDM tables that do not exist yet.

        They are marked, so that a later stage does not take one for a built table.
        """
        for name, schema in schemas.CDM.items():
            if name not in tables:
                first, *rest = schema.fields
                mark = T.StructField(first.name, first.dataType, first.nullable, {UNBUILT: True})
                empty = spark.createDataFrame([], T.StructType([mark, *rest]))
                empty = sinks.observed(empty, name, tables.seen(name))
                empty.write.mode("overwrite").parquet(f"{tables.out}/{name}")

    def constraints():
        """Integrity reports over the tables built so far, as tables below ``checks``."""
        built = {n: df for n in schemas.CDM if (df := tables.declared(n)) is not None}
        target = _Tables(spark, f"{tables.out}/checks")
        target.write_work("primary_keys", quality.check_primary_keys(built))
        target.write_work("foreign_keys", quality.check_foreign_keys(built | vocabulary))
        target.write_work("not_null", quality.check_not_null(built))
        tables.done.update({f"checks/{name}": df for name, df in target.done.items()})
        tables.written += [(f"checks/{name}", seen) for name, seen in target.written]

    def build_maps():
        relationship = vocabulary["concept_relationship"]
        tables.write_work("source_to_concept_map", vocab.build_source_map(concept, relationship))
        tables.write_work(
            "code_map", vocab.code_map(tables["source_to_concept_map"], concept), ("use",)
        )
        tables.write_work(
            "ingredient_map", vocab.ingredient_map(vocabulary["concept_ancestor"], concept)
        )

    def master():
        lines = {source: raw[name] for name, source in SOURCES.items()}
        keys.write_keyed_sources(lines, raw["t20"], f"{tables.out}/keyed", ranges)
        seq = keys.seq_master(
            *(keyed(name) for name in SOURCES),
            keys.yearly_master(raw["gj"], "hchk_year", keys.SCREENING, ranges),
            keys.yearly_master(raw["jk"], "stnd_y", keys.ELIGIBILITY, ranges),
        )
        tables.write_work("seq_master", seq, ("source_table",))

    def keyed(name: str) -> DataFrame:
        try:
            return keys.read_keyed_source(spark, f"{tables.out}/keyed", SOURCES[name])
        except AnalysisException as error:
            raise KeyError(f"keyed lines of {name} are not stored: run stage master") from error

    def lines() -> tuple[DataFrame, DataFrame]:
        return keyed("t30"), keyed("t60")

    def make_eras():
        tables.write_identified(
            "drug_era",
            eras.drug_era_spans(tables["drug_exposure"], tables["ingredient_map"]),
            eras.DRUG_ERA_ORDER,
            "drug_era_id",
            eras.DRUG_GROUP,
        )
        tables.write_identified(
            "condition_era",
            eras.condition_era_spans(tables["condition_occurrence"]),
            eras.CONDITION_ERA_ORDER,
            "condition_era_id",
            eras.CONDITION_GROUP,
        )

    def indexing():
        for name in sinks.SORT_COLUMN:
            if name in tables:
                sinks.write_bucketed(
                    tables[name],
                    f"indexed_{name}",
                    buckets,
                    path=f"{tables.out}/indexed/{name}",
                    seen=tables.seen(f"indexed_{name}"),
                )

    def cleansing():
        target = _Tables(spark, f"{tables.out}/cleansed")
        periods = tables["observation_period"]
        for name, rule in CLEANSED.items():
            rows = tables[name]
            # Columns without values are not moved; they are added again where rows are written.
            rows = rule(rows.select(*tables.filled.get(name, rows.columns)), periods)
            if name == "device_exposure":
                rows = cleanse.device_quantity_zero_to_one(rows)
            target.write(name, rows)
        if overrides is not None:
            target.write("person", cleanse.patch_person(tables["person"], overrides))
        tables.done.update(target.done)
        tables.written += target.written

    steps = {
        "ddl": create_tables,
        "constraints": constraints,
        "vocabulary": build_maps,
        "cdm_source": lambda: tables.write(
            "cdm_source", sinks.cdm_source(spark, concept, today or dt.date.today())
        ),
        "master": master,
        "location": lambda: tables.write("location", visits.location(regions)),
        "care_site": lambda: tables.write("care_site", visits.care_site(raw["yk"])),
        "person": lambda: tables.write("person", person.person(raw["jk"])),
        "death": lambda: tables.write(
            "death", person.death(raw["jk"], tables["code_map"], seeds.seed_death_map(spark))
        ),
        "observation_period": lambda: tables.write_identified(
            "observation_period",
            person.observation_period(raw["jk"], tables["person"], tables["death"]),
            ["person_id", "observation_period_start_date"],
            "observation_period_id",
        ),
        "visit_occurrence": lambda: tables.write(
            "visit_occurrence",
            visits.visit_occurrence(raw["t20"], raw["gj"], tables["seq_master"]),
        ),
        "condition_occurrence": lambda: tables.write(
            "condition_occurrence",
            events.condition_occurrence(keyed("t40"), tables["observation_period"], tables["code_map"]
            ),
        ),
        "observation": lambda: tables.write(
            "observation",
            screening.observation(
                raw["gj"],
                raw["jk"],
                tables["seq_master"],
                seeds.seed_observation_map(spark),
                seeds.seed_observation_map_2009(spark),
                early_years,
                late_years,
            ),
        ),
        "drug_exposure": lambda: tables.write(
            "drug_exposure", events.drug_exposure(*lines(), tables["death"], tables["code_map"])
        ),
        "procedure_occurrence": lambda: tables.write(
            "procedure_occurrence",
            events.procedure_occurrence(*lines(), tables["drug_exposure"], tables["code_map"]),
        ),
        "device_exposure": lambda: tables.write(
            "device_exposure", events.device_exposure(*lines(), tables["code_map"])
        ),
        "measurement": lambda: tables.write(
            "measurement",
            screening.measurement(
                raw["gj"], tables["seq_master"], seeds.seed_measurement_map(spark)
            ),
        ),
        "payer_plan_period": lambda: tables.write(
            "payer_plan_period", money.payer_plan_period(raw["jk"], tables["death"])
        ),
        "cost": lambda: tables.write(
            "cost",
            money.cost(
                tables["visit_occurrence"],
                tables["drug_exposure"],
                tables["procedure_occurrence"],
                tables["device_exposure"],
                raw["t20"],
                *lines(),
                tables["code_map"],
                ranges,
            ),
        ),
        "eras": make_eras,
        "dose_era": lambda: tables.write_identified(
            "dose_era",
            eras.dose_era_spans(tables["drug_exposure"], tables["ingredient_map"]),
            eras.DOSE_ERA_ORDER,
            "dose_era_id",
            eras.DRUG_GROUP,
        ),
        "indexing": indexing,
        "data_cleansing": cleansing,
    }
    entries = []
    for stage in chosen:
        before, started = len(tables.written), time.monotonic()
        steps[stage]()
        seconds = time.monotonic() - started
        written = [(name, seen.get) for name, seen in tables.written[before:]]
        entries += [(stage, name, seen, seconds) for name, seen in sorted(written, key=lambda w: w[0])]
        log.info(
            "stage %s took %.1f s: %s", stage, seconds, {name: seen["rows"] for name, seen in written}
        )
    log_table = sinks.stage_log(spark, entries)
    log_table.write.mode("overwrite").parquet(f"{tables.out}/stage_log")
    tables.done["stage_log"] = spark.read.parquet(f"{tables.out}/stage_log")
    return tables.done
