"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has 64 bits: bit b is set if it is set in over half of the XXH64 hashes (seed 42) of
the text's word shingles, repeats included. Two fingerprints that differ in at most 2r bits have a
common point within r bits of both, so every *distinct* fingerprint emits its ball of radius r
(1 + 64 points for r = 1), points are shuffled, and fingerprints that meet in a point are verified.

Equal fingerprints are collapsed before the balls, so a group of copies of any size costs one ball.
Distinct fingerprints within r of a point number at most the size of a ball (65), and neighbours in
sorted order are linked rather than all pairs; a chain through a point's members keeps all of
them connected, because members of a point are at most 2r bits apart. Links therefore lose no
component. Odd distances floor(distance / 2) + 1 would be needed on one side: the radius is rounded
up, and verification drops links beyond ``max_bits``.

Defined cases: null text is an empty text; an empty text or one of white space has fingerprint
zero, linked like any other; fewer words than a shingle give one shingle of all words; rows with a
null doc_id get a fingerprint and take part as members, a component's id is its smallest non-null
doc_id (null if it has none); repeated rows are returned as often as they come.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, components

#: Words hashed at once, so that one very long text needs bounded memory.
SLICE = 1 << 18


def _bit_counts(buffer: bytes, lengths: list[int], words: int) -> tuple[np.ndarray, int]:
    """How many shingles have each bit set; ``buffer`` holds the words joined by one space."""
    ends = list(accumulate(n + 1 for n in lengths))
    starts = [0, *ends[:-1]]
    size, digest = min(words, len(lengths)), xxhash.xxh64_intdigest
    total, n = np.zeros(64, np.int64), len(lengths) - size + 1
    for at in range(0, n, SLICE):
        hashes = np.array(
            [
                digest(buffer[a : b - 1], 42)
                for a, b in zip(
                    starts[at : min(at + SLICE, n)],
                    ends[at + size - 1 : min(at + SLICE, n) + size - 1],
                    strict=True,
                )
            ],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return total, n


def fingerprint(text: bytes, words: int = 3) -> int:
    """64-bit SimHash of lower-cased (A-Z) words between ASCII white space."""
    split = text.lower().split()
    if not split:
        return 0
    total, n = _bit_counts(b" ".join(split), list(map(len, split)), words)
    return int.from_bytes(np.packbits(2 * total > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, bits): the fingerprint as a signed long."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([fingerprint(t, words) for t in common.texts(batch)], np.uint64)
        return common.record_batch(
            doc_id=batch.column("doc_id"), bits=pa.array(values.view(np.int64))
        )

    return common.map_batches(common.documents(docs, "text"), run, "doc_id long, bits long")


def _ball(radius: int) -> list[int]:
    """XOR masks of up to ``radius`` bits as signed longs."""
    masks = [
        sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(64), k)
    ]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(bits: DataFrame, max_bits: int = 2) -> DataFrame:
    """Verified links (a, b) between distinct fingerprints that connect every near pair.

    ``bits`` has one row for each distinct fingerprint, column bits. They are dealt over all partitions
    first: a fingerprint is small, its ball is not.
    """
    # By a hash of their own, as Spark would take a split by the column itself for the one it has.
    bits = bits.repartition(common.partitions(bits.sparkSession), F.xxhash64("bits"))
    masks = F.array(*[F.lit(m).cast("long") for m in _ball(max_bits // 2)])
    points = bits.select("bits", F.explode(masks).alias("_mask")).select(
        "bits", F.col("bits").bitwiseXOR(F.col("_mask")).alias("point")
    )
    met = Window.partitionBy("point").orderBy("bits")
    pairs = points.select("bits", F.lag("bits").over(met).alias("other")).filter(
        F.col("other").isNotNull()
    )
    near = F.bit_count(F.col("bits").bitwiseXOR(F.col("other"))) <= max_bits
    return pairs.filter(near).select(F.col("other").alias("a"), F.col("bits").alias("b")).distinct()


def _classes(docs: DataFrame, words: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, bits) for each row, and (bits, component_id, root) for each distinct fingerprint.

    ``root`` names the component also where a doc_id of several texts is the smallest of several.
    """
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    prints = common.stored(fingerprints(docs, words), "simhash")
    distinct = prints.groupBy("bits").agg(F.min("doc_id").alias("first_id"))
    edges = common.stored(links(distinct.select("bits"), max_bits), "simhash-links")
    roots = components.components(edges)
    classes = distinct.join(roots, F.col("bits") == F.col("node"), "left").select(
        "bits", "first_id", F.coalesce("root", "bits").alias("root")
    )
    # One row for each distinct fingerprint; the smallest doc_id of a component spreads to its members.
    smallest = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = common.stored(
        classes.join(smallest, "root").select("bits", "component_id", "root"), "simhash-classes"
    )
    return prints, named


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """(doc_id, bits, component_id) for each row of ``docs``.

    ``max_bits`` must be even: for 2r bits the balls have radius r and every member of a point is
    near every other, which is what lets a chain stand for all pairs.
    """
    prints, named = _classes(docs, words, max_bits)
    return prints.join(named, "bits").select("doc_id", "bits", "component_id")


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """The document of the smallest doc_id of each component, columns unchanged.

    Of rows of a component that share this doc_id the one of least text stays; rows that share a
    doc_id in different components are different documents. Rows without doc_id are told apart by
    their text and give way to others of their component.
    """
    rows = common.packed(docs)
    read = rows.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text"))
    prints, named = _classes(read, words, max_bits)
    found = prints.join(named, "bits").groupBy("doc_id").agg(
        F.bool_or(F.col("doc_id") == F.col("component_id")).alias("first"),
        (F.min("root") != F.max("root")).alias("clash"),
    )
    first = common.stored(found.filter("first").select("doc_id", "clash"), "simhash-first")

    def of(which: DataFrame) -> DataFrame:
        return rows.join(which, F.col("key") == F.col("doc_id"), "left_semi")

    def one(survivors: DataFrame, group: str) -> DataFrame:
        by = Window.partitionBy(group).orderBy("row.text")
        return survivors.withColumn("nth", F.row_number().over(by)).filter("nth = 1").select("row.*")

    kept = one(of(first.filter("not clash")), "key")
    if first.filter("clash").isEmpty():
        return kept

    # Only rows of clashing ids need their fingerprints again, to tell their components.
    clashing = of(first.filter("clash")).select("key", "row", F.col("row.text").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([fingerprint(t, words) for t in common.texts(batch)], np.uint64)
        return batch.set_column(2, "bits", pa.array(values.view(np.int64)))

    schema = clashing.drop("text").withColumn("bits", F.lit(0).cast("long")).schema
    told = common.map_batches(clashing, run, schema).join(named, "bits")
    return kept.unionAll(one(told.filter("key = component_id"), "root"))
