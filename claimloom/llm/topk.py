"""Exact top-k search by inner product: columnar branch and bound.

Queries and candidates are dealt into blocks of equal expected size; one task gets a block of each.
It holds the candidates in vertical layout, a row for each dimension, the dimensions of largest
spread first. For a query it adds up products one block of dimensions at a time; the product of the
remaining parts' lengths (Cauchy-Schwarz) bounds what is still missing. Candidates whose bound
stays below the query's k-th best score so far are dropped and the survivors compacted, before the
next block. Candidates come in chunks by descending length, so later chunks often lose whole.

Every task returns k rows a query; the best k of all blocks are exact, ties to the smaller vec_id.

Components are taken as floor(scale * x) with x as a double, so scores are whole numbers. Values whose
products could leave 2**53 are summed with unbounded integers and cut to the range of a long.

Defined cases: vectors that are null or hold null, NaN or infinite components take no part; vectors
of different lengths are filled up with zeros; an empty vector scores 0; rows without vec_id take no
part; rows that share a vec_id are one candidate with its best score, and are not candidates of
that vec_id's own query; no queries or no candidates give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Dimensions added up between two compactions, candidates of a chunk.
DIMENSIONS, CHUNK = 16, 4096
#: Queries and candidates that meet in one task, on average, at most.
QUERY_BLOCK, CANDIDATE_BLOCK = 4096, 32768
#: Bytes of the doubles of a cell, of which a task holds some copies; candidates for which a further
#: task is worth its queries.
CELL_BYTES, LEAST_BLOCK = 32 << 20, 16384
EXACT = float(1 << 53)


def _matrix(rows: list[np.ndarray], scale: float, width: int) -> np.ndarray:
    """Vertical layout: one row for each dimension, whole numbers as doubles."""
    out = np.zeros((width, len(rows)))
    for i, row in enumerate(rows):
        out[: len(row), i] = np.floor(scale * np.asarray(row, np.float64))
    return out


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (score descending, id ascending), each id once."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    first = np.sort(np.unique(ids, return_index=True)[1])[:k]
    return ids[first], scores[first]


def search_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    """(query id, id, score) of the k best candidates of each query in one block.

    ``queries`` and ``vectors`` have a row for each dimension. Scores must fit a double exactly.
    """
    order = np.argsort(-(vectors**2).sum(axis=1), kind="stable")
    queries, vectors = queries[order], vectors[order]
    by_length = np.argsort(-(vectors**2).sum(axis=0), kind="stable")
    ids, vectors = ids[by_length], np.ascontiguousarray(vectors[:, by_length])
    cuts = list(range(0, len(vectors), DIMENSIONS)) or [0]

    def rest(of: np.ndarray) -> np.ndarray:
        """Length of what is left from each cut on, rounded up a little."""
        squares = np.cumsum((of**2)[::-1], axis=0)[::-1]
        return np.sqrt(squares[cuts] if len(of) else np.zeros((1, of.shape[1]))) * (1 + 1e-9)

    query_rest, vector_rest = rest(queries), rest(vectors)
    out = []
    for q, query_id in enumerate(query_ids):
        query, own_rest = queries[:, q], query_rest[:, q]
        best_ids, best = np.zeros(0, np.int64), np.zeros(0)
        for start in range(0, len(ids), CHUNK):
            alive = np.arange(start, min(start + CHUNK, len(ids)))
            # Nothing in this chunk or later can do it: lengths descend.
            floor = best[-1] if len(best) == k else -np.inf
            if own_rest[0] * vector_rest[0, start] + 1 < floor:
                break
            alive = alive[ids[alive] != query_id]
            sums = np.zeros(len(alive))
            for b, cut in enumerate(cuts):
                bound = sums + own_rest[b] * vector_rest[b, alive] + 1
                keep = bound >= floor
                if not keep.all():
                    alive, sums = alive[keep], sums[keep]
                if not len(alive):
                    break
                part = slice(cut, cut + DIMENSIONS)
                # Only a chunk that is still whole is a view; survivors are gathered.
                first, end = alive[0], alive[-1] + 1
                whole = end - first == len(alive)
                sums = sums + query[part] @ (vectors[part, first:end] if whole else vectors[part][:, alive])
            keep = sums >= floor
            if keep.any():
                best_ids, best = _best(
                    np.r_[best_ids, ids[alive[keep]]], np.r_[best, sums[keep]], k
                )
        out += [(int(query_id), int(i), int(s)) for i, s in zip(best_ids, best, strict=True)]
    return out


def _large(query_ids, queries, ids, vectors, k):
    """The same with unbounded integers, for components beyond the exact range of a double."""
    low, high = -(1 << 63), (1 << 63) - 1
    columns = [[int(x) for x in v] for v in vectors.T]
    out = []
    for query_id, query in zip(query_ids, queries.T, strict=True):
        own = [int(x) for x in query]
        best: dict[int, int] = {}
        for i, column in zip(ids, columns, strict=True):
            if i != query_id:
                score = min(high, max(low, sum(a * b for a, b in zip(own, column, strict=True))))
                best[int(i)] = max(score, best.get(int(i), low))
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(int(query_id), i, s) for i, s in ranked]
    return out


def _cell(k: int, scale: float):
    def run(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(candidates):
            rows = [*queries["vector"], *candidates["vector"]]
            width = max(map(len, rows))
            every = _matrix(rows, scale, width)
            most = np.abs(every).max(initial=0.0)
            search = search_block if most * most * max(width, 1) < EXACT else _large
            n = len(queries)
            found = search(
                queries["id"].to_numpy(), every[:, :n], candidates["id"].to_numpy(), every[:, n:], k
            )
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def grid(n: int, asking: int, width: int, tasks: int) -> tuple[int, int]:
    """Blocks of queries and of candidates: cells of bounded bytes, and as many as there are tasks."""
    fit = max(1, CELL_BYTES // (8 * max(width, 1)))
    query_blocks = max(1, -(-asking // min(QUERY_BLOCK, max(1, fit // 4))))
    blocks = max(1, -(-n // min(CANDIDATE_BLOCK, fit)))
    wanted = min(-(-tasks // query_blocks), -(-n // LEAST_BLOCK))
    return query_blocks, max(blocks, wanted)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows for each row that ``is_query``.

    ``vectors`` has the columns vec_id and embedding; ``is_query`` is a condition on vec_id.
    """
    good = ~F.exists(
        "vector",
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))),
    )
    usable = vectors.select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("embedding").cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & good)
    n, asking, width = usable.agg(
        F.count("*"), F.count_if("asks"), F.coalesce(F.max(F.size("vector")), F.lit(0))
    ).first()
    query_blocks, blocks = grid(n, asking, width, common.partitions(vectors.sparkSession))
    cells = max(query_blocks * blocks, common.partitions(vectors.sparkSession))
    place = F.xxhash64("id", "vector")
    queries = usable.filter("asks").select(
        "id", "vector", F.pmod(place, F.lit(query_blocks)).alias("qb"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("cb"),
    )
    candidates = usable.select(
        "id", "vector", F.pmod(place, F.lit(blocks)).alias("cb"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))).alias("qb"),
    )
    common.prepare(vectors.sparkSession)
    # Cells are heavy for their bytes: their number of partitions is named, so none are put together.
    found = (
        queries.repartition(cells, "qb", "cb").groupBy("qb", "cb")
        .cogroup(candidates.repartition(cells, "qb", "cb").groupBy("qb", "cb"))
        .applyInPandas(_cell(k, scale), "query_id long, vec_id long, score long")
    )
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        once.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
