"""Embedding whitening with MLlib's BlockMatrix.

Entries become whole numbers x = floor(scale * c) + shift. Rows are gathered where they are read into
blocks of ``BLOCK_BYTES``, numbered and stored; sums of each dimension are exact. Centred blocks form a
distributed BlockMatrix X; its transpose times X is the scatter matrix, whose eigenvectors the driver
takes from a matrix of dimension by dimension. X times the eigenvectors over the roots of the
eigenvalues is the projection, whose covariance is then measured.

MLlib deals a tall matrix into only the square root of the asked partitions, so the factor asks for
the square of what is wanted, and X is taken in panels of at most ``PANEL`` blocks: no task holds more
than about 1/``TASKS`` of a panel.

Eigenvectors are unit vectors by falling eigenvalue; the entry of largest size is positive. Components
whose eigenvalue is zero to double precision have no whitened values and are left out.

Defined cases: vectors that are null or hold null, NaN or infinite entries take no part, nor do those
of another length than the most common (of several, the longest), which lack entries; a null vec_id
is a row like any other, as are rows that share one; no rows, one row or equal rows give no components
and so no rows. Numbers beyond 2**52 are cut there. A squared deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Bytes of a block of doubles, blocks of a panel, blocks of a task and tasks of a product at most.
BLOCK_BYTES, PANEL, TASK_BLOCKS, TASKS = 1 << 20, 1 << 14, 8, 256
#: Dimensions at most: the driver and each task hold a matrix of so many rows and columns.
DIMENSIONS = 4096
LARGEST = 1 << 52
#: Numbers of a block are stored as bytes, row by row.
LONG, DOUBLE = "<i8", "<f8"


def whole_vectors(vectors: DataFrame, scale: float, shift: int) -> DataFrame:
    """(vec_id, x): usable rows with entries floor(scale * c) + shift."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    read = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
    ).filter(F.col("v").isNotNull() & ~F.exists("v", bad))
    sizes = read.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows"))
    common_size = sizes.orderBy(F.desc("rows"), F.desc("n")).first()
    n = common_size.n if common_size else 0
    if n > DIMENSIONS:
        raise ValueError(f"vectors have {n} entries, whitening takes {DIMENSIONS} at most")
    cut = lambda c: F.least(F.greatest(F.floor(c * scale), F.lit(-LARGEST)), F.lit(LARGEST))
    return read.filter(F.size("v") == n).select(
        "vec_id", F.transform("v", lambda c: (cut(c) + shift).cast("long")).alias("x")
    )


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    """The lists of a column as rows of numbers."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(rows, -1)


def _block_rows(width: int, block_bytes: int) -> int:
    return max(1, block_bytes // (8 * max(width, 1)))


def _to_blocks(block_bytes: int):
    """Rows of a task in blocks: ids, and x row by row as bytes."""

    def block(ids: list[pa.Array], rows: list[np.ndarray]) -> pa.RecordBatch:
        flat = np.concatenate(rows).reshape(-1)
        return common.record_batch(
            n=pa.array([sum(map(len, ids))], pa.int64()),
            ids=pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64())),
            x=pa.array([flat.astype(LONG).tobytes()], pa.binary()),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, held = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix, at = _matrix(batch.column("x"), batch.num_rows), 0
            most = _block_rows(matrix.shape[1], block_bytes)
            while at < batch.num_rows:
                take = min(most - held, batch.num_rows - at)
                ids.append(batch.column("vec_id").slice(at, take))
                rows.append(matrix[at : at + take])
                at, held = at + take, held + take
                if held == most:
                    yield block(ids, rows)
                    ids, rows, held = [], [], 0
        if held:
            yield block(ids, rows)

    return run


def _numbered(blocks: DataFrame) -> DataFrame:
    """Adds ``block``: 0, 1, ... over the stored table, from one count for each of its partitions."""
    placed = common.stored(
        blocks.withColumn("part", F.spark_partition_id()).withColumn(
            "nth", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        ),
        "whitening-blocks",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part").agg(F.count("*").alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
    )
    return placed.join(F.broadcast(starts), "part").select(
        (F.col("start") + F.col("nth")).cast("int").alias("block"), "n", "ids", "x"
    )


def _sums(blocks: DataFrame, width: int) -> list[int]:
    """Exact sum of each dimension: of high and low halves, each within a long for any one block."""

    def halves_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, low = np.zeros(width, np.int64), np.zeros(width, np.int64)
            for n, x in zip(batch.column("n").to_pylist(), batch.column("x"), strict=True):
                matrix = np.frombuffer(x.as_buffer(), LONG).reshape(n, width)
                high += (matrix >> 32).sum(axis=0)
                low += (matrix & 0xFFFFFFFF).sum(axis=0)
            yield common.record_batch(
                dimension=pa.array(np.arange(width)), high=pa.array(high), low=pa.array(low)
            )

    halves = blocks.select("n", "x").mapInArrow(halves_of, "dimension long, high long, low long")
    total = lambda name: F.sum(F.col(name).cast("decimal(38,0)")).alias(name)
    rows = halves.groupBy("dimension").agg(total("high"), total("low")).collect()
    out = [0] * width
    for r in rows:
        out[r.dimension] = (int(r.high) << 32) + int(r.low)
    return out


def _block_matrix(blocks: RDD, rows: int, width: int, n_blocks: int) -> BlockMatrix:
    return BlockMatrix(blocks, rows, width, n_blocks * rows, width)


def _centred(blocks: DataFrame, first: int, rows: int, means: np.ndarray) -> RDD:
    """((block, 0), matrix) from block ``first`` on; a short block is filled up with zeros."""

    def block(r) -> tuple[tuple[int, int], DenseMatrix]:
        values = np.zeros((rows, len(means)))
        values[: r.n] = np.frombuffer(r.x, LONG).reshape(r.n, -1) - means
        return (r.block - first, 0), DenseMatrix(rows, len(means), values.ravel(order="F"))

    return blocks.select("block", "n", "x").rdd.map(block)


def _times(one: BlockMatrix, other: BlockMatrix, splits: int) -> BlockMatrix:
    """Product whose middle dimension is cut into ``splits``: MLlib's option that Python does not name.

    Without it all blocks of a product with one block of result meet in one task.
    """
    made = one._java_matrix_wrapper.call("multiply", other._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(made, one.rowsPerBlock, other.colsPerBlock)


def eigen(scatter: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Positive eigenvalues by size, their unit vectors as columns, and the trace of the covariance."""
    covariance = (scatter + scatter.T) / (2.0 * max(n, 1))
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    floor = max(values[0], 0.0) * len(values) * np.finfo(float).eps if len(values) else 0.0
    keep = values > floor
    values, vectors = values[keep], vectors[:, keep]
    if len(values):
        top = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))]
        vectors = vectors * np.where(top < 0, -1.0, 1.0)
    return values, vectors, float(np.trace(covariance))


@dataclass
class Whitening:
    """What was learned from the rows: exact counts and sums, eigenvalues, the matrix of projection."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def means(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n * x - S)**2 of each row, exact; None beyond a long."""
    most = max((abs(n * int(v) - s) for s, col in zip(sums, x.T, strict=True) for v in (col.min(), col.max())), default=0)
    if most * most * max(len(sums), 1) < 1 << 63 and n * int(np.abs(x).max(initial=0)) < 1 << 62:
        centred = n * x - np.array(sums, np.int64)
        return (centred * centred).sum(axis=1).tolist()
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return [d if d < 1 << 63 else None for d in exact]


def whiten(
    vectors: DataFrame, components: int = 8, scale: float = 1024.0, shift: int = 100000,
    block_bytes: int = BLOCK_BYTES, panel_blocks: int = PANEL,
) -> tuple[Whitening | None, DataFrame]:
    """What was learned, and (vec_id, deviation, y) for each usable row; y has a value a component."""
    spark, schema = vectors.sparkSession, "vec_id long, deviation long, y array<double>"
    common.prepare(spark)
    blocks = _numbered(
        whole_vectors(vectors, scale, shift).mapInArrow(_to_blocks(block_bytes), "n long, ids array<long>, x binary")
    )
    n, n_blocks, width = blocks.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.max(F.octet_length("x") / (8 * F.col("n"))).cast("int")
    ).first()
    if not n or not width:
        return None, spark.createDataFrame([], schema)
    learned = Whitening(n, _sums(blocks, width), np.zeros(0), np.zeros((width, 0)), 0.0)
    means, rows = learned.means, _block_rows(width, block_bytes)
    panels = range(0, n_blocks, panel_blocks)

    def panel(first: int) -> BlockMatrix:
        of = blocks.filter(F.col("block").between(first, first + panel_blocks - 1))
        return _block_matrix(
            _centred(of, first, rows, means), rows, width, min(panel_blocks, n_blocks - first)
        )

    # Tasks of one product over a panel: some blocks each, and so its square remains small.
    tasks = min(TASKS, -(-min(n_blocks, panel_blocks) // TASK_BLOCKS))
    scatter = np.zeros((width, width))
    for first in panels:
        x = panel(first)
        scatter += _times(x.transpose(), x, tasks).toLocalMatrix().toArray()
    values, axes, trace = eigen(scatter, n)
    learned.values, learned.vectors, learned.trace = values[:components], axes[:, :components], trace
    k = len(learned.values)
    if not k:
        return learned, spark.createDataFrame([], schema)
    factor = learned.vectors / np.sqrt(learned.values)
    one = [((0, 0), DenseMatrix(width, k, factor.ravel(order="F")))]
    parts = []
    for first in panels:
        weights = BlockMatrix(
            spark.sparkContext.parallelize(one, tasks * tasks), width, k, width, k
        )
        projected = _times(panel(first), weights, 1)
        found = projected.blocks.map(
            lambda b, first=first: (first + b[0][0], b[1].toArray().astype(DOUBLE).tobytes())
        )
        parts.append(common.stored(spark.createDataFrame(found, "block int, y binary"), "whitening-projected"))
    projected = parts[0]
    for part in parts[1:]:
        projected = projected.unionAll(part)
    sums = learned.sums

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, own, x, y in zip(*(batch.column(c) for c in ("n", "ids", "x", "y")), strict=True):
                matrix = np.frombuffer(x.as_buffer(), LONG).reshape(size.as_py(), width)
                values = np.frombuffer(y.as_buffer(), DOUBLE)[: len(matrix) * k]
                edges = pa.array(np.arange(0, len(values) + 1, k), pa.int32())
                yield common.record_batch(
                    vec_id=own.values, deviation=pa.array(deviation(matrix, n, sums), pa.int64()),
                    y=pa.ListArray.from_arrays(edges, pa.array(values)),
                )

    joined = blocks.join(projected, "block").select("n", "ids", "x", "y")
    return learned, joined.mapInArrow(unpacked, schema)


def identity_error(projected: DataFrame, components: int) -> float | None:
    """Largest absolute entry of the covariance of y (divisor n, centred) less the identity."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    y = F.col("y")
    found = projected.agg(
        *[F.covar_pop(y[i], y[j]).alias(f"c{i}_{j}") for i, j in pairs]
    ).first()
    return max((abs(c - (i == j)) for c, (i, j) in zip(found, pairs, strict=True)), default=None)


def whitened_rows(vectors: DataFrame, components: int = 8, **more) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each row and component."""
    learned, rows = whiten(vectors, components, **more)
    k = len(learned.values) if learned else 0
    rows = common.stored(rows, "whitened")
    error = identity_error(rows, k) if k else None
    share = [float(e / learned.trace) for e in learned.values] if k else []
    shares = F.array(*map(F.lit, share)) if k else F.lit(None).cast("array<double>")
    return rows.select(
        "vec_id", F.posexplode("y").alias("place", "whitened"), "deviation"
    ).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"),
        F.lit(learned.n if learned else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
