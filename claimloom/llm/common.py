"""Helpers of the document operators: stored intermediates, Arrow batches, salted numbering."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..work import fresh_path

#: Texts handed to a Python function at once hold at most so many bytes (or one row).
BATCH_BYTES = 2 << 20
#: Spark's own bound on the bytes of a batch, which is unset by default.
BATCH_CONF, UNBOUNDED = "spark.sql.execution.arrow.maxBytesPerBatch", str((1 << 31) - 1)

_shipped: set[str] = set()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage, so a lost executor never repeats more than the tasks of one step, and
    several readers do not compute it again.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(df: DataFrame, *columns: str) -> DataFrame:
    """``doc_id`` as long and the named columns; other columns of the input do not matter."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), *columns)


def bounded(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``BATCH_BYTES`` of the column at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > BATCH_BYTES:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def row_key() -> Column:
    """The doc_id, or for a null doc_id a number beyond 2**62 that its text decides."""
    own = F.lit(1 << 62) + F.pmod(F.xxhash64("text"), F.lit(1 << 61))
    return F.coalesce(F.col("doc_id").cast("long"), own)


def packed(docs: DataFrame) -> DataFrame:
    """(key, row): whole rows under one name, so that no column of theirs can clash."""
    return docs.select(row_key().alias("key"), F.struct("*").alias("row"))


def prepare(spark: SparkSession) -> None:
    """Before Python runs in tasks: bounds Arrow batches by bytes, unless the session does so
    already, and hands this package to the executors, unless PYTHONPATH names it.
    """
    if spark.conf.get(BATCH_CONF, None) in (None, UNBOUNDED):
        spark.conf.set(BATCH_CONF, str(4 * BATCH_BYTES))
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root, name = os.path.split(package)
    context = spark.sparkContext
    known = any(os.path.realpath(p) == root for p in os.environ.get("PYTHONPATH", "").split(":") if p)
    if not known and context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        archive = os.path.join(tempfile.mkdtemp(prefix="package-"), name)
        context.addPyFile(shutil.make_archive(archive, "zip", root, name))


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType,
    column: str = "text",
) -> DataFrame:
    """``function`` over bounded Arrow batches of ``df``; it may return None for no rows."""

    prepare(df.sparkSession)

    def run(batches):
        for batch in bounded(batches, column):
            out = function(batch)
            if out is not None:
                yield out

    return df.mapInArrow(run, schema)


def record_batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 of each text, b"" for null."""
    return batch.column(column).cast(pa.binary()).fill_null(b"").to_pylist()


#: Bytes of a text whose words are hashed at once.
PIECE = 1 << 20
_SPACES = b" \t\n\r\x0b\x0c"
_IS_SPACE = np.isin(np.arange(256), list(_SPACES))
_ODD = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(11).integers(0, 1 << 64, 256, dtype=np.uint64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(size: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if len(_powers[0]) < size:
        for i, base in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            steps = np.full(max(size, 1 << 16), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


def _piece_hashes(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    edges = np.flatnonzero(np.diff(~_IS_SPACE[data], prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    powers, inverse = _grown(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return hashes ^ (hashes >> np.uint64(29))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word between ASCII white space, for a whole text at once.

    A word's hash is a polynomial in its bytes, taken from running sums over the text; long texts
    are hashed in pieces that end at white space.
    """
    parts, at = [], 0
    while len(text) - at > PIECE:
        end = max(text.rfind(bytes([c]), at, at + PIECE) for c in _SPACES)
        if end <= at:
            # One word is longer than a piece.
            found = [e for c in _SPACES if (e := text.find(bytes([c]), at + 1)) > 0]
            end = min(found, default=len(text))
        parts.append(_piece_hashes(text[at:end]))
        at = end
    parts.append(_piece_hashes(text[at:]) if at < len(text) else np.zeros(0, np.uint64))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def gapless(df: DataFrame, group: Column, order: list[Column], buckets: int, name: str) -> DataFrame:
    """Adds ``name``: 0, 1, ... within each group, without one task holding a whole group.

    Rows of a group are dealt into ``buckets`` by a hash of the order columns; a bucket starts where
    the buckets before it end, so only one count per group and bucket is summed in a single place.
    Equal rows may swap their numbers, which leaves the result as a whole the same.
    """
    from pyspark.sql import Window

    dealt = df.withColumn("_g", group).withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = dealt.groupBy("_g", "_b").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("_g").alias("_sg"), F.col("_b").alias("_sb"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
    )
    place = F.row_number().over(Window.partitionBy("_g", "_b").orderBy(*order)) - 1
    return (
        dealt.withColumn("_place", place)
        .join(starts, F.col("_g").eqNullSafe(F.col("_sg")) & (F.col("_b") == F.col("_sb")))
        .withColumn(name, (F.col("_start") + F.col("_place")).cast("long"))
        .drop("_g", "_b", "_sg", "_sb", "_start", "_place")
    )


def ordered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds ``name``: the place of each row in the whole order, from 0.

    Rows are dealt into ranges and stored, numbered within their range, and shifted by the rows of the
    ranges before; only one count for each range is summed in a single place.
    """
    from pyspark.sql import Window

    ranged = stored(
        df.repartitionByRange(partitions(df.sparkSession), *order).withColumn(
            "_r", F.spark_partition_id()
        ),
        "ordered",
    )
    before = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_r").agg(F.count("*").alias("_n")).select(
        "_r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    place = F.row_number().over(Window.partitionBy("_r").orderBy(*order)) - 1
    return (
        ranged.withColumn("_place", place)
        .join(F.broadcast(starts), "_r")
        .withColumn(name, (F.col("_start") + F.col("_place")).cast("long"))
        .drop("_r", "_place", "_start")
    )
