"""Document fingerprints: one-permutation MinHash with optimal densification and packed low bits.

Every word shingle is hashed once; the high bits of the hash name a bin, the least rest of each bin
is kept. An empty bin takes the value of the bin that a sequence of hashes of its own number hits
first among the full ones, so that two texts with the same full bins fill the others alike. The low
``BITS`` bits of each value, hashed with its bin, are packed into a hex string. Two fingerprints
agree in a bin by chance with probability c = 2 ** -BITS; their likeness is
(share of equal bins - c) / (1 - c), cut to 0..1.

Defined cases: null text is empty; fewer words than a shingle make one shingle of all words; a text
without words has the fingerprint of zeros in all bins, like 1 to its own kind and, whatever the
bins say, 0 to all others; equal texts have equal fingerprints; a one-row table has itself as next
document; rows with equal doc_id follow each other by text, null doc_id comes last.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WORDS, BINS, BITS = 5, 256, 4
_MIX = np.uint64(0x9E3779B97F4A7C15)
SLICE = 1 << 18
#: Sampled ids for each range of doc_ids.
SAMPLED = 8


def _probes(bins: int) -> np.ndarray:
    """For each bin (row) a fixed sequence of bins to borrow from; it visits every bin."""
    return np.array([np.random.default_rng([bins, b]).permutation(bins) for b in range(bins)])


PROBES = _probes(BINS)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words from the hashes of the words (of all, if fewer)."""
    size = min(size, len(words))
    n = len(words) - size + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(size):
        mixed = (mixed ^ words[k : k + n]) * _MIX
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def sketch(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Low bits of the densified bins, one byte a bin."""
    if not len(words):
        return np.zeros(BINS, np.uint8)
    shift = np.uint64(64 - BINS.bit_length() + 1)
    least = np.full(BINS, np.iinfo(np.uint64).max)
    for at in range(0, max(1, len(words) - size + 1), SLICE):
        hashes = shingle_hashes(words[at : at + SLICE + size - 1], size)
        rest = hashes & ((np.uint64(1) << shift) - np.uint64(1))
        np.minimum.at(least, (hashes >> shift).astype(np.intp), rest)
    full = least != np.iinfo(np.uint64).max
    empty = np.flatnonzero(~full)
    if len(empty):
        tries = PROBES[empty]
        least[empty] = least[tries[np.arange(len(empty)), full[tries].argmax(axis=1)]]
    # Low bits of a hash of value and bin: bins that borrowed one value agree by chance one by one.
    least = (least + np.arange(1, BINS + 1, dtype=np.uint64) * _MIX) * np.uint64(0xBF58476D1CE4E5B9)
    least = (least ^ (least >> np.uint64(32))) * _MIX
    return ((least ^ (least >> np.uint64(29))) & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def pack(bins: np.ndarray) -> str:
    return ((bins[0::2] << 4) | bins[1::2]).astype(np.uint8).tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not a.any() or not b.any():
        return float(np.array_equal(a, b))
    chance = 2.0**-BITS
    return min(1.0, max(0.0, (float((a == b).mean()) - chance) / (1 - chance)))


def fingerprints(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """(doc_id, fingerprint) for each row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = [pack(sketch(common.word_hashes(t), size)) for t in common.texts(batch)]
        return common.record_batch(doc_id=batch.column("doc_id"), fingerprint=pa.array(prints, pa.string()))

    return common.map_batches(common.documents(docs, "text"), run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many, or all, of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half] if half else text


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
_KINDS = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}
_ARROW = pa.schema([(name, _KINDS[kind]) for name, kind in map(str.split, SCHEMA.split(", "))])


def _follow(batches):
    """Rows of a range come in order, each range followed by the first row of the next one."""
    held = None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("range", "doc_id", "copy", "text"))
        out = {name: [] for name in _ARROW.names}
        for which, doc_id, copy, text in zip(*columns, strict=True):
            text = text or ""
            bins = sketch(common.word_hashes(text.encode()))
            if held is not None and held[0] == which:
                _, before_id, before, before_bins = held
                changed = edited(before, text)
                raw = changed.encode()
                changed_bins = before_bins if changed == before else sketch(common.word_hashes(raw))
                row = (
                    before_id, len(before), hashlib.sha256(raw).hexdigest(), pack(before_bins),
                    pack(changed_bins), likeness(before_bins, changed_bins),
                    likeness(before_bins, bins),
                )
                for column, value in zip(out.values(), row, strict=True):
                    column.append(value)
            # Of the rows that begin the next range only the first is needed; none follows it here.
            held = None if copy else (which, doc_id, text, bins)
        yield pa.RecordBatch.from_pydict(out, _ARROW)


def with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edit with the next document, by descending doc_id.

    doc_ids are cut into ranges at some of their own values (a hash sample of the ids alone), so the
    first document of every range is known by its id. It is sent to the range before as well,
    which is all that a range needs from another; texts are shuffled once.
    """
    spark = docs.sparkSession
    docs = common.documents(docs, "text")
    ranges = 4 * common.partitions(spark)
    ids = docs.select("doc_id")
    rows, known_ids, top = ids.agg(F.count("*"), F.count("doc_id"), F.max("doc_id")).first()
    one_of = max(1, known_ids // (ranges * SAMPLED))
    sampled = ids.filter(F.pmod(F.xxhash64("doc_id"), F.lit(one_of)) == 0).distinct().collect()
    found = sorted({r.doc_id for r in sampled} - {None}, reverse=True)
    # Range i holds ids from its first one down to, not including, the first one of range i + 1.
    firsts = found[:: max(1, len(found) // ranges)]
    firsts = [*([] if top is None or firsts[:1] == [top] else [top]), *firsts]
    firsts = [*firsts, *([None] if rows > known_ids else [])]
    ascending = np.array([f for f in reversed(firsts) if f is not None], np.int64)
    last = len(firsts) - 1

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("doc_id").to_pylist()
        take, at, copy = [], [], []
        for i, x in enumerate(ids):
            here = last if x is None else len(ascending) - 1 - int(np.searchsorted(ascending, x))
            take.append(i), at.append(here), copy.append(False)
            if x == firsts[here]:
                take.append(i), at.append(here - 1 if here else last), copy.append(True)
        rows = batch.take(pa.array(take, pa.int32()))
        return common.record_batch(
            range=pa.array(at, pa.int32()), doc_id=rows.column("doc_id"),
            copy=pa.array(copy), text=rows.column("text"),
        )

    dealt = common.map_batches(docs, deal, "range int, doc_id long, copy boolean, text string")
    return (
        dealt.repartition(common.partitions(spark), "range")
        .sortWithinPartitions("range", "copy", F.col("doc_id").desc_nulls_last(), "text")
        .mapInArrow(_follow, SCHEMA)
    )
