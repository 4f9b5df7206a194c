"""Eras over a stream of exposures: session windows per person and concept.

An exposure opens a session from its start to 30 days after its end; exposures whose sessions
overlap are one era, as in the batch form. An era is closed, and written, once the watermark has
passed the end of its session. The watermark trails the latest start seen by ``lateness``; an
exposure whose own session the watermark has passed is late: it is dropped, as the era it belongs
to may be written already.

Every era holds how many rows it took, so rows that came and are in no era are counted exactly,
whatever batches, crashes and restarts there were: :func:`late_rows`. That is final once the stream
is finished; before, rows of eras that are still open are among them.

The state is the start days of open eras, one set for each person and concept; it goes when the era
is closed. It lies in RocksDB on the executors' disks, whose memory is bounded, unless the session names
another store: in the heap the open eras of a year, twice, would have to fit. Files, offsets, state and finished batches are in the checkpoint beside the target, so a
later or repeated run goes on where the last one ended.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.eras import GAP_DAYS
from ..operators.keys import unsent
from ..operators.vocab import ingredient_rollup
from .ingest import _check_same_log

#: A closing row starts so late that the watermark passes every other row; it is never in an era.
CLOSING_DAY = dt.date(9000, 1, 1)
STATE = "spark.sql.streaming.stateStore"
PROVIDER = f"{STATE}.providerClass"
#: How a new stream keeps its state; a later run goes on with the store of its checkpoint.
STATE_STORE = {
    PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{STATE}.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the rows of the state would look up each row that is put.
    f"{STATE}.rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def _state_store(spark: SparkSession) -> Iterator[None]:
    """The settings of the state for a query started inside, which copies the session's."""
    if spark.conf.get(PROVIDER, None) is not None:
        yield
        return
    own = {k: v for k, v in STATE_STORE.items() if spark.conf.get(k, None) is None}
    for key, value in own.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in own:
            spark.conf.unset(key)


@dataclass(frozen=True)
class Exposures:
    """Columns of a stream of exposures; ``kind`` splits eras that share their days, if given."""

    concept: str
    start: str
    end: str
    kind: str | None = None
    supply: str | None = None

    def span(self) -> tuple[Column, Column]:
        """Start and end; a missing end is the supplied days later, or the next day."""
        start, days = F.col(self.start), [F.date_add(self.start, 1)]
        if self.supply:
            days.insert(0, F.date_add(self.start, F.col(self.supply)))
        return start, F.greatest(start, F.coalesce(self.end, *days))


CONDITIONS = Exposures("condition_concept_id", "condition_start_date", "condition_end_date")
DRUGS = Exposures(
    "drug_concept_id",
    "drug_exposure_start_date",
    "drug_exposure_end_date",
    "drug_type_concept_id",
    "days_supply",
)


def _spans(rows: DataFrame, columns: Exposures, ingredients: DataFrame | None) -> DataFrame:
    """(person_id, concept, kind, start, end) of each exposure, or of each ingredient of it."""
    start, end = columns.span()
    kind = F.col(columns.kind) if columns.kind else F.lit(None).cast("int")
    spans = rows.select("person_id", columns.concept, kind.alias("kind"), start.alias("start"), end.alias("end"))
    concept = F.col(columns.concept)
    if ingredients is not None:
        spans = ingredient_rollup(spans, ingredients)
        concept = F.col("ingredient_concept_id")
    return spans.select("person_id", concept.alias("concept_id"), "kind", "start", "end")


def era_sessions(spans: DataFrame, lateness: str) -> DataFrame:
    """(person_id, concept_id, kind, era_start, era_end, starts, source_rows) of closed eras.

    ``spans`` may be a stream or not. One row for each era and kind of exposure in it: ``era_start``
    and ``starts`` (distinct start days) are those of the kind, ``era_end`` that of the era.
    """
    # Half a day more than the gap: a start on the last day of the gap still belongs to the era.
    open_for = F.concat(
        (F.datediff("end", "start") + GAP_DAYS).cast("string"), F.lit(" days 12 hours")
    )
    day = F.struct("kind", "start")
    sessions = (
        spans.where(F.col("start").isNotNull())
        .withColumn("at", F.col("start").cast("timestamp"))
        .withWatermark("at", lateness)
        .groupBy("person_id", "concept_id", F.session_window("at", open_for).alias("session"))
        .agg(
            F.max("end").alias("era_end"),
            F.collect_set(day).alias("days"),
            F.count(F.lit(1)).alias("source_rows"),
        )
    )
    kinds = F.array_distinct(F.transform("days", lambda d: d["kind"]))
    own = F.filter("days", lambda d: d["kind"].eqNullSafe(F.col("kind")))
    # The rows of the era are told once, with its first kind.
    first = F.col("place") == 0
    return (
        sessions.select("person_id", "concept_id", "era_end", "days", "source_rows", F.posexplode(kinds).alias("place", "kind"))
        .select(
            "person_id",
            "concept_id",
            "kind",
            F.array_min(F.transform(own, lambda d: d["start"])).alias("era_start"),
            "era_end",
            F.size(own).cast("bigint").alias("starts"),
            F.when(first, F.col("source_rows")).otherwise(0).alias("source_rows"),
        )
    )


class EraStream:
    """Eras of the exposure files below ``source``, written to ``target`` as they close.

    ``source`` holds Parquet files of the columns of ``schema``; drug eras need the ingredients of
    each drug, a table that must not change between runs. :meth:`run` takes the files that are new
    and stops; :meth:`finish` closes all eras, after which every further row is late.
    """

    def __init__(
        self,
        spark: SparkSession,
        source: str,
        schema: T.StructType,
        target: str,
        columns: Exposures,
        ingredients: DataFrame | None = None,
        lateness: str = "366 days",
        files_per_batch: int = 64,
    ):
        self.spark, self.source, self.target = spark, source.rstrip("/"), target.rstrip("/")
        self.columns, self.ingredients, self.lateness = columns, ingredients, lateness
        self.files_per_batch = files_per_batch
        wanted = {"person_id", columns.concept, columns.start, columns.end, columns.kind, columns.supply}
        self.schema = T.StructType([f for f in schema.fields if f.name in wanted])
        self.checkpoint, self.closing = f"{self.target}.checkpoint", f"{self.target}.closing"

    def _read(self, path: str) -> DataFrame:
        reader = self.spark.readStream.schema(self.schema)
        return reader.option("maxFilesPerTrigger", self.files_per_batch).parquet(path)

    def _closing_rows(self, closed: bool) -> DataFrame:
        row = tuple(CLOSING_DAY if f.name == self.columns.start else None for f in self.schema)
        nullable = T.StructType([T.StructField(f.name, f.dataType) for f in self.schema])
        return self.spark.createDataFrame([row] if closed else [], nullable)

    def run(self) -> DataFrame:
        """Take all files that are not read yet; returns the eras closed so far."""
        _check_same_log(self.spark, self.target, self.checkpoint)
        if not self._exists(self.closing):
            self._closing_rows(False).write.parquet(self.closing)
        spans = _spans(self._read(self.source), self.columns, self.ingredients).unionByName(
            _spans(self._read(self.closing), self.columns, None)
        )
        with _state_store(self.spark):
            query = (
                era_sessions(spans, self.lateness)
                .writeStream.format("parquet")
                .outputMode("append")
                .option("checkpointLocation", self.checkpoint)
                .trigger(availableNow=True)
                .start(self.target)
            )
        query.awaitTermination()
        return self.eras()

    def finish(self) -> DataFrame:
        """Close all open eras: the last run of the stream."""
        self._closing_rows(True).coalesce(1).write.mode("append").parquet(self.closing)
        return self.run()

    def _exists(self, path: str) -> bool:
        try:
            self.spark.read.schema(self.schema).parquet(path)
            return True
        except AnalysisException:
            return False

    def eras(self) -> DataFrame:
        return self.spark.read.parquet(self.target)

    def late_rows(self) -> DataFrame:
        """(person_id, concept_id, rows, late): rows that came and how many of them are in no era."""
        came = _spans(self.spark.read.schema(self.schema).parquet(self.source), self.columns, self.ingredients)
        came = came.where(F.col("start").isNotNull()).groupBy("person_id", "concept_id")
        taken = self.eras().groupBy("person_id", "concept_id").agg(F.sum("source_rows").alias("taken"))
        keys = ["person_id", "concept_id"]
        counted = came.agg(F.count("*").alias("rows")).alias("c").join(
            unsent(taken.alias("t")),
            F.col("c.person_id").eqNullSafe(F.col("t.person_id"))
            & F.col("c.concept_id").eqNullSafe(F.col("t.concept_id")),
            "left",
        )
        return counted.select(
            *(F.col(f"c.{k}") for k in keys), "rows", (F.col("rows") - F.coalesce("taken", F.lit(0))).alias("late")
        )


def condition_eras(closed: DataFrame) -> DataFrame:
    """Closed eras of conditions in the shape of the batch form, without ids."""
    return closed.select(
        "person_id",
        F.col("concept_id").alias("condition_concept_id"),
        F.col("era_start").alias("condition_era_start_date"),
        F.col("era_end").alias("condition_era_end_date"),
        F.col("starts").alias("condition_occurrence_count"),
    )


def drug_eras(closed: DataFrame) -> DataFrame:
    """Closed eras of drugs in the shape of the batch form, without ids."""
    return closed.select(
        "person_id",
        F.col("concept_id").alias("drug_concept_id"),
        F.col("era_start").alias("drug_era_start_date"),
        F.col("era_end").alias("drug_era_end_date"),
        F.col("starts").alias("drug_exposure_count"),
        F.lit(GAP_DAYS).alias("gap_days"),
    )
