"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target in words; a document's expected copies are target / source size, the same
for all documents of a source. The whole part is taken as it is; the fractions are rounded by the
pivotal method with unequal sizes: two documents with fractions p, q and sizes s, t trade words
(p grows by d / s while q shrinks by d / t) by one of the two largest possible amounts, drawn so
that both keep their expectation, until one fraction is 0 or 1. The words expected from the pair
never change, so a whole source ends with a single open fraction.

Documents of a source are dealt into buckets by a hash; each bucket leaves one open document, and
these are rounded again, ``FAN_IN`` buckets at a time, until one is left per source: a reduction tree
whose every group is small. In a source's last group the open fraction goes to the nearer whole
number, and the words this misses are made up by turning decisions of that group, the largest
documents that bring the sum nearer first.

Defined cases: null or blank text has size 0 and is taken 0 times; null is a source of its own and
comes last; a source without words has target 0; rows with equal doc_id are documents of their own;
an empty table gives no rows. The draws depend only on ``seed``, source, bucket and tree level.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of a bucket on average, and buckets combined in one group of the tree.
BUCKET_ROWS, FAN_IN = 2_000, 512


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, docs, target) for rows (source, source_size, docs), one a source.

    Weights repeat over the sources by code point, null last. Targets stop at ``most`` times a
    source's size; what is cut off is shared by weight until none is above. Each round of this is
    one aggregate of a row, the table of sources stays distributed.
    """
    ranked = common.stored(
        common.ordered(sizes, [F.col("source").asc_nulls_last()], "rank")
        .withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.col("rank") % len(weights)))
        .withColumn("cap", F.col("source_size") * most),
        "mix-sources",
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) >= F.col("cap")
        n, fixed, open_weight = ranked.agg(
            F.count_if(above),
            F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
        ).first()
        if n == capped or not open_weight:
            break
        capped, level = n, (total - fixed) / open_weight
    share = F.least(F.col("weight") * F.lit(float(level)), F.col("cap").cast("double"))
    return ranked.select("source", "source_size", "docs", share.alias("target"))


def _settle(size: np.ndarray, p: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, int]:
    """Rounds fractions ``p`` in order; the place of the one left open, or -1."""
    p, held = p.tolist(), -1
    sizes = size.tolist()
    for i, s in enumerate(sizes):
        if p[i] <= 0 or p[i] >= 1:
            continue
        if held < 0:
            held = i
            continue
        a, b, t = p[held], p[i], sizes[held]
        up, down = min((1 - a) * t, b * s), min(a * t, (1 - b) * s)
        # Held gains `up` words or loses `down`; the one that hits its end becomes whole exactly.
        if draw[i] * (up + down) < down:
            if (1 - a) * t <= b * s:
                p[held], p[i] = 1.0, b - up / s
            else:
                p[held], p[i] = a + up / t, 0.0
        elif a * t <= (1 - b) * s:
            p[held], p[i] = 0.0, b + down / s
        else:
            p[held], p[i] = a - down / t, 1.0
        if p[held] in (0.0, 1.0):
            held = i if 0 < p[i] < 1 else -1
    return np.array(p), held


def _close(size: np.ndarray, p: np.ndarray, was_open: np.ndarray, held: int) -> np.ndarray:
    """Rounds the last open fraction and turns other decisions to make up for it."""
    nearer = float(round(p[held]))
    missing = (p[held] - nearer) * size[held]
    p[held], was_open[held] = nearer, False
    for i in np.flatnonzero(was_open):
        if missing > 0 and p[i] < 0.5 and size[i] < 2 * missing:
            p[i], missing = 1.0, missing - size[i]
        elif missing < 0 and p[i] > 0.5 and size[i] < -2 * missing:
            p[i], missing = 0.0, missing + size[i]
    return p


def _round(level: int, seed: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "order", "key"], ascending=[False, True, True])
        name = f"{seed}:{level}:{frame['source'].iloc[0]!r}:{frame['bucket'].iloc[0]}"
        draw = np.random.default_rng(xxhash.xxh64_intdigest(name)).random(len(frame))
        size, p = frame["size"].to_numpy(), frame["p"].to_numpy()
        was_open = (p > 0) & (p < 1)
        p, held = _settle(size, p, draw)
        opened = np.zeros(len(frame), bool)
        if held >= 0 and frame["buckets"].iloc[0] > 1:
            opened[held] = True
        elif held >= 0:
            p = _close(size, p, was_open, held)
        return frame.assign(p=p, open=opened)

    return run


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 42,
    key: Column | None = None,
) -> DataFrame:
    """(key, doc_id, source, size, source_size, target, copies) for each row of ``docs``.

    ``key`` tells rows apart, doc_id unless given.
    """
    common.prepare(docs.sparkSession)
    key = F.col("doc_id").cast("long") if key is None else key
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = common.stored(
        docs.select(
            key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "source",
            words.alias("size"),
        ),
        "mix-sizes",
    )
    wanted = common.stored(
        targets(
            sized.groupBy("source").agg(
                F.sum("size").alias("source_size"), F.count("*").alias("docs")
            ),
            weights, most,
        ),
        "mix-targets",
    )
    other = F.col("source").eqNullSafe(F.col("of"))
    expected = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    order = F.xxhash64(F.lit(seed), "key")
    shares = sized.join(wanted.withColumnRenamed("source", "of"), other).drop("of").withColumns(
        {
            "copies": F.floor(expected).cast("long"),
            "p": expected - F.floor(expected),
            "order": order,
            "buckets": F.ceil(F.col("docs") / BUCKET_ROWS),
            "bucket": F.pmod(order, F.ceil(F.col("docs") / BUCKET_ROWS)),
        }
    )
    columns = ["key", "doc_id", "source", "size", "source_size", "target", "copies", "order", "p"]
    schema = (
        "key long, doc_id long, source string, size long, source_size long, target double, "
        "copies long, order long, p double, buckets long, bucket long, open boolean"
    )
    current = shares.select(*columns, "buckets", "bucket")
    out, level = None, 0
    while True:
        done = common.stored(
            current.groupBy("source", "bucket").applyInPandas(_round(level, seed), schema),
            f"mix-{level}",
        )
        closed = done.filter(~F.col("open"))
        out = closed if out is None else out.unionByName(closed)
        # Nothing stays open in the last group of a source.
        if (done.agg(F.max("buckets")).first()[0] or 1) == 1:
            break
        current = done.filter("open").select(
            *columns,
            F.ceil(F.col("buckets") / FAN_IN).alias("buckets"),
            F.floor(F.col("bucket") / FAN_IN).alias("bucket"),
        )
        level += 1
    return out.select(
        "key", "doc_id", "source", "size", "source_size", "target",
        (F.col("copies") + F.round("p").cast("long")).alias("copies"),
    )


def repeat(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 42
) -> DataFrame:
    """Each document as often as the mix takes it, columns unchanged; 0 times drops it.

    Rows that share a doc_id share their copies: each gets the mean, the first ones by text one more.
    """
    rows = common.packed(docs)
    mixed = mix(docs, weights, most, seed, common.row_key())
    total = mixed.groupBy(F.col("key").alias("of")).agg(
        F.sum("copies").alias("copies"), F.count("*").alias("n")
    )
    nth = F.row_number().over(Window.partitionBy("key").orderBy("row.text"))
    more = (F.col("nth") <= F.col("copies") % F.col("n")).cast("int")
    return (
        rows.join(total, F.col("key") == F.col("of"))
        .withColumn("nth", nth)
        .withColumn("times", (F.floor(F.col("copies") / F.col("n")) + more).cast("int"))
        .select("row", F.explode(F.array_repeat(F.lit(0), F.col("times"))))
        .select("row.*")
    )
