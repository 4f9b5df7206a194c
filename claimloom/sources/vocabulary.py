"""Vocabulary files: tab-separated text with a header, no quoting, one file per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.vocab import normalise_vocabulary

# The tables that come as files, and their date format.
TABLES = (
    "concept",
    "concept_synonym",
    "concept_relationship",
    "concept_ancestor",
    "drug_strength",
    "vocabulary",
    "domain",
    "concept_class",
    "relationship",
)
DATE_FORMAT = "yyyyMMdd"
# End of fixed values.

CORRUPT = "_corrupt_record"


def _file_schema(table: str, corrupt: bool) -> T.StructType:
    fields = [T.StructField(f.name, f.dataType) for f in schemas.VOCABULARY[table]]
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType()))
    return T.StructType(fields)


def read_vocabulary_table(
    spark: SparkSession, folder: str, table: str, keep_bad: bool = False
) -> DataFrame:
    """One vocabulary file with its declared types; lines end with LF, text is UTF-8.

    With ``keep_bad`` lines that do not parse stay, with their text in ``_corrupt_record``;
    otherwise the read stops at the first of them.
    """
    return (
        spark.read.schema(_file_schema(table, keep_bad))
        .options(
            sep="\t",
            header=True,
            quote="",
            lineSep="\n",
            encoding="UTF-8",
            dateFormat=DATE_FORMAT,
            mode="PERMISSIVE" if keep_bad else "FAILFAST",
            columnNameOfCorruptRecord=CORRUPT,
        )
        .csv(f"{folder.rstrip('/')}/{table.upper()}.csv")
    )


def load_vocabulary(
    spark: SparkSession, folder: str, target: str, bad_records: str | None = None
) -> dict[str, DataFrame]:
    """Replace the stored vocabulary by the files of ``folder`` and return the tables.

    With ``bad_records`` rejected lines are written there per table instead of failing.
    """
    out = {}
    for table in TABLES:
        path = f"{target.rstrip('/')}/{table}"
        df = read_vocabulary_table(spark, folder, table, bad_records is not None)
        if bad_records is not None:
            df.where(F.col(CORRUPT).isNotNull()).write.mode("overwrite").parquet(
                f"{bad_records.rstrip('/')}/{table}"
            )
            df = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
        normalise_vocabulary(df).write.mode("overwrite").parquet(path)
        out[table] = spark.read.parquet(path)
    return out
