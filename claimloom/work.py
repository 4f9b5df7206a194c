"""Intermediate tables written to the shared folder the cluster names.

Used where a plan must not be evaluated twice with different row order (row
numbers) and where several operators read the same stage. A written table cuts
lineage and survives the loss of any executor.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Stored tables are written once and read a few times; this takes a third less than the default.
CODEC = "zstd"

# Folders of local sessions without the setting, by application.
_private: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """Shared folder from ``spark.checkpoint.dir``.

    Where that is unset a local session gets a private folder; a cluster must name one.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        # The setting itself cannot be changed once a session runs.
        application = spark.sparkContext.applicationId
        if application not in _private:
            _private[application] = tempfile.mkdtemp(prefix="claimloom-")
        root = _private[application]
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{work_root(spark)}/claimloom/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as Parquet under a fresh folder and return the stored table."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path, compression=CODEC)
    # The schema is passed in, so partition values keep their type.
    return spark.read.schema(df.schema).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path for it: Spark's readers hide log folders."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def file_numbers(spark: SparkSession, folder: str) -> set[int]:
    """The leading numbers of the names of a folder's files; none if there is no such folder."""
    files, where = _hadoop(spark, folder)
    if not files.exists(where):
        return set()
    names = [status.getPath().getName() for status in files.listStatus(where)]
    return {int(m[0]) for name in names if (m := re.match(r"\d+", name))}


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _hadoop(spark, path)
    return files.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    files, where = _hadoop(spark, path)
    files.delete(where, True)
