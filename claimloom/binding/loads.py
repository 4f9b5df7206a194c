"""Files written from the bound tables, as the yearly and vocabulary files come, and loaded again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import loader, seeds, vocabulary
from ..streaming import ingest
from ..work import fresh_path
from .stages import Stages

#: Claim headers per year; odd years lack the DRG column, as older files lack newer columns.
CLAIM_FILE, CLAIM_COLUMNS = "claims_{year}.csv", ("key_seq", "person_id", "form_cd", "dmd_drg_no")
SYNONYM_LANGUAGE = 4180186


def _claims(s: Stages) -> DataFrame:
    return s.t20.select(*CLAIM_COLUMNS, F.substring("recu_fr_dt", 1, 4).cast("int").alias("year"))


def years(s: Stages) -> list[int]:
    """The years of the claims; one number each."""
    return sorted(r.year for r in _claims(s).select("year").distinct().collect())


def write_years(s: Stages, chosen: list[int] | None = None, folder: str | None = None) -> str:
    """Yearly claim files below a work folder."""
    folder = folder or fresh_path(s.spark, "yearly")
    for year in years(s) if chosen is None else chosen:
        rows = _claims(s).where(F.col("year") == year).drop("year")
        if year % 2:
            rows = rows.drop("dmd_drg_no")
        rows.write.csv(f"{folder}/{CLAIM_FILE.format(year=year)}", header=True)
    return folder


def union_columns(s: Stages) -> DataFrame:
    folder = write_years(s)
    paths = [f"{folder}/{CLAIM_FILE.format(year=y)}" for y in [*years(s), 1900]]
    names = loader.union_columns(s.spark, paths)
    found = s.spark.createDataFrame([(n,) for n in names], "column_name string")
    # How many claims have a value there, so the names are tied to the rows that were read.
    loaded = load_years(s, folder)
    filled = loaded.select(*[F.count(n).alias(n) for n in names]).unpivot(
        [], names, "column_name", "filled"
    )
    return found.join(filled, "column_name")


def load_years(s: Stages, folder: str | None = None) -> DataFrame:
    """Years before and after the first and last are missing and skipped."""
    own = years(s)
    asked = range(own[0] - 1, own[-1] + 2) if own else [1900]
    return loader.load_years(s.spark, folder or write_years(s), CLAIM_FILE, asked)


def write_raw(s: Stages) -> DataFrame:
    """A first load replaces what an earlier one left, later loads append."""
    loaded, target = load_years(s), fresh_path(s.spark, "raw-loads")
    odd, even = (loaded.where(F.col("load_year") % 2 == k) for k in (1, 0))
    loader.write_raw(loaded, target, first=True)
    loader.write_raw(odd, target, first=True)
    loader.write_raw(even, target, first=False)
    return s.spark.read.parquet(target)


def load_single(s: Stages) -> DataFrame:
    folder = fresh_path(s.spark, "single")
    s.yk.write.csv(f"{folder}/yk.csv", header=True)
    return loader.load_single(s.spark, f"{folder}/yk.csv", f"{folder}/yk")


def ingest_incremental(s: Stages) -> DataFrame:
    """Two calls, files added in between; the checkpoint lies beside the target."""
    folder, own = fresh_path(s.spark, "stream"), years(s)
    schema = "key_seq bigint, person_id bigint, form_cd string"
    for chosen in (own[::2], own[1::2]):
        for year in chosen:
            rows = _claims(s).where(F.col("year") == year).select("key_seq", "person_id", "form_cd")
            rows.write.mode("append").csv(f"{folder}/in", header=True)
        loaded = ingest.ingest_incremental(s.spark, f"{folder}/in", schema, f"{folder}/out")
    return loaded


def ingest_incremental_batch(s: Stages) -> DataFrame:
    """Called twice over the same files: the second call adds only the year that was missing."""
    own, target = years(s), fresh_path(s.spark, "batches")
    folder = write_years(s, own[:-1])
    loader.ingest_incremental_batch(s.spark, folder, CLAIM_FILE, own, own[0] + 1, target)
    write_years(s, own[-1:], folder)
    loader.ingest_incremental_batch(s.spark, folder, CLAIM_FILE, own, own[0] + 1, target)
    return s.spark.read.option("mergeSchema", True).parquet(target)


def synonyms(s: Stages) -> DataFrame:
    """Synonyms of the bound concepts; names repeat for concepts with several relations."""
    names = s.concept.select("concept_id", F.col("vocabulary_id").alias("concept_synonym_name"))
    return names.unionByName(
        s.relationship.select(
            F.col("concept_id_1").alias("concept_id"), F.lit("EDI").alias("concept_synonym_name")
        )
    ).withColumn("language_concept_id", F.lit(SYNONYM_LANGUAGE))


def write_vocabulary(s: Stages, bad: bool = False) -> str:
    """Tab-separated files as the vocabulary comes; with ``bad`` some dates are no dates."""
    from .. import schemas

    folder = fresh_path(s.spark, "vocabulary-files")
    given = {
        "concept": s.raw_concept, "concept_relationship": s.raw_relationship,
        "concept_ancestor": s.ancestor, "concept_synonym": synonyms(s),
    }
    for table in vocabulary.TABLES:
        schema = schemas.VOCABULARY[table]
        df = given.get(table)
        if df is None:
            df = s.spark.createDataFrame([], schema)
        columns = []
        for field in schema:
            column = F.col(field.name) if field.name in df.columns else F.lit(None)
            if field.dataType.typeName() == "date":
                column = F.date_format(column, vocabulary.DATE_FORMAT)
                if bad and table == "concept" and field.name == "valid_end_date":
                    column = F.when(F.col("concept_id") % 50 == 7, F.lit("never")).otherwise(column)
            columns.append(F.coalesce(column.cast("string"), F.lit("")).alias(field.name))
        df.select(*columns).write.csv(
            f"{folder}/{table.upper()}.csv", sep="\t", header=True, emptyValue="", quote="\u0000"
        )
    return folder


def load_vocabulary(s: Stages, bad: bool = False) -> dict[str, DataFrame]:
    """The stored vocabulary; with ``bad`` also the rejected lines, as ``bad_concept``."""
    target = fresh_path(s.spark, "vocabulary")
    rejected = f"{target}-bad" if bad else None
    out = vocabulary.load_vocabulary(s.spark, write_vocabulary(s, bad), target, rejected)
    if bad:
        out["bad_concept"] = s.spark.read.parquet(f"{rejected}/concept")
    return out


def seed_location(s: Stages) -> DataFrame:
    folder = fresh_path(s.spark, "regions")
    s.regions.write.csv(folder, header=True)
    return seeds.seed_location(s.spark, folder)
