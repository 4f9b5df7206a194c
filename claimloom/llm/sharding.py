"""Sharding indivisible groups by best-fit-decreasing bin packing.

A group is all rows of one text. Packing is done twice with the same procedure: within a bucket of
groups each task packs groups into parcels of a fixed capacity, and the parcels of all buckets are then
packed into the shards. A parcel is a small share of a shard, so the driver packs a bounded number of
parcels (about ``2 * shards * PARCELS`` plus one for each bucket of ``BUCKET_GROUPS`` groups), whatever
the number of rows. Groups larger than a parcel are parcels of their own.

The second packing searches the smallest shard capacity that needs no more than the given shards,
which makes the sizes near equal. A group larger than an equal share still stays whole.

Defined cases: null text has no bytes, size 1 and checksum 0, and forms a group with empty texts;
rows with null or equal doc_id are placed and numbered like any others (equal rows may swap their
slots); an empty table gives no rows.
"""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Parcels in a shard, groups packed by one task.
PARCELS, BUCKET_GROUPS = 256, 100_000
#: Buckets that number the rows of one shard.
SLOT_BUCKETS = 512


class CapacityTree:
    """Bins by remaining capacity in a balanced search tree (a treap): tightest fit in log time."""

    def __init__(self):
        self.root, self.draw = None, random.Random(7).random

    def _split(self, node, key):
        """Trees of the entries below ``key`` and of the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[2], right = self._split(node[2], key)
            return node, right
        left, node[1] = self._split(node[1], key)
        return left, node

    def _merge(self, left, right):
        if left is None or right is None:
            return left or right
        if left[3] < right[3]:
            left[2] = self._merge(left[2], right)
            return left
        right[1] = self._merge(left, right[1])
        return right

    def add(self, remaining: int, which: int) -> None:
        left, right = self._split(self.root, (remaining, which))
        node = [(remaining, which), None, None, self.draw()]
        self.root = self._merge(self._merge(left, node), right)

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the entry with the least remaining capacity of ``size`` or more."""
        left, right = self._split(self.root, (size, -1))
        if right is None:
            self.root = left
            return None
        path, node = None, right
        while node[1] is not None:
            path, node = node, node[1]
        if path is None:
            right = node[2]
        else:
            path[1] = node[2]
        self.root = self._merge(left, right)
        return node[0]


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], int]:
    """The bin of each size and the number of bins; sizes must come in descending order.

    A size above the capacity gets a bin of its own.
    """
    tree, bins, n = CapacityTree(), [], 0
    for size in sizes:
        found = tree.take(size)
        if found is None:
            found, n = (capacity, n), n + 1
        bins.append(found[1])
        if found[0] > size:
            tree.add(found[0] - size, found[1])
    return bins, n


def near_equal(sizes: list[int], shards: int) -> list[int]:
    """Shards of descending sizes: the smallest capacity, by bisection, that needs no more shards.

    A size of an equal share or more gets a shard of its own first.
    """
    own, rest = 0, sum(sizes)
    while own < min(len(sizes), shards - 1) and sizes[own] * (shards - own) >= rest:
        rest -= sizes[own]
        own += 1
    small, share = sizes[own:], -(-rest // (shards - own))
    if not small:
        return list(range(own))
    low, high = max(share, small[0]), max(2 * share, small[0])
    best = best_fit(small, high)[0]
    while low < high:
        middle = (low + high) // 2
        bins, n = best_fit(small, middle)
        if n <= shards - own:
            best, high = bins, middle
        else:
            low = middle + 1
    return [*range(own), *(own + b for b in best)]


def _parcels(capacity: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bytes", "h1", "h2"], ascending=[False, True, True])
        bins, _ = best_fit(frame["bytes"].tolist(), capacity)
        return frame.assign(parcel=bins)

    return run


def shard_by_bytes(docs: DataFrame, shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row; size is UTF-8 bytes plus 1.

    ``slot`` numbers the rows of a shard from 0 without gaps.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    text = F.coalesce("text", F.lit(""))
    digest = F.sha2(text, 256)
    part = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    rows = common.stored(
        common.documents(
            docs,
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            part(1).alias("h1"),
            part(16).alias("h2"),
        ),
        "shard-rows",
    )
    groups = common.stored(
        rows.groupBy("h1", "h2").agg(F.sum("size").alias("bytes")), "shard-groups"
    )
    total, n = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*")).first()
    capacity = max(1, total // (shards * PARCELS))
    bucket = F.pmod("h1", F.lit(max(1, -(-n // BUCKET_GROUPS))))
    packed = common.stored(
        groups.withColumn("bucket", bucket)
        .groupBy("bucket")
        .applyInPandas(
            _parcels(capacity), "h1 long, h2 long, bytes long, bucket long, parcel int"
        ),
        "shard-parcels",
    )
    parcels = (
        packed.groupBy("bucket", "parcel")
        .agg(F.sum("bytes").alias("bytes"))
        .orderBy(F.desc("bytes"), "bucket", "parcel")
        .collect()
    )
    shard = near_equal([p.bytes for p in parcels], shards)
    placed = spark.createDataFrame(
        [(p.bucket, p.parcel, s) for p, s in zip(parcels, shard, strict=True)],
        "bucket long, parcel int, shard int",
    )
    homes = packed.join(F.broadcast(placed), ["bucket", "parcel"]).select("h1", "h2", "shard")
    found = common.stored(
        rows.join(homes, ["h1", "h2"]).select("doc_id", "size", "text_crc32", "shard"), "shard-homes"
    )
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    return common.gapless(found, F.col("shard"), order, SLOT_BUCKETS, "slot")
