"""Spelling variants by asymmetric q-chunks.

Two words are near if one code point is inserted, deleted or replaced. Cut a word in two disjoint
halves: the edit leaves one of them whole. The damaged half is cut again in the same way, until the part
that may be damaged has ``LEAF`` code points (or the word was cut ``CUTS`` times): what is left on
either side of it are the word's chunks, at known positions. A word of length n emits its chunks; the
other word, of length n or n + 1, emits its grams of the same lengths at the same positions, those
behind the damaged part shifted by none or by one. Words that share chunk and grams meet in an
equi-join on a hash of both and are verified by their edit distance.

Cutting once only would leave groups as large as all words with a common beginning; after the further
cuts a group holds words that differ within a few code points.

The joins never gather a side on the driver: the planner sees the compressed words, of which each emits up
to sixteen chunks.

Words are counted with one partial count a task, so the shuffle holds distinct words only. Each word
points to its most frequent near word; pointers are followed by doubling, as a stored table a round.

Defined cases: null text has no words; a null doc_id counts as an empty one in the hash; repeated rows
count again; no words give no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import unsent
from . import common

#: Code points that may be damaged in the end, cuts of a word at most.
LEAF, CUTS = 2, 4
#: Distinct words (or bytes of them) that a task holds before it hands on their counts.
HELD_WORDS, HELD_BYTES = 1 << 18, 32 << 20


def _letters() -> bytes:
    """A-Z in lower case, a-z and U+00C0 to U+00FF stay, other Latin-1 bytes become blanks."""
    kept = np.full(256, 32, np.uint8)
    kept[0xC0:] = np.arange(0xC0, 0x100)
    kept[0x61:0x7B] = np.arange(0x61, 0x7B)
    kept[0x41:0x5B] = kept[0x61:0x7B]
    return kept.tobytes()


_LETTERS = _letters()


def runs(text: str) -> list[bytes]:
    """Lower-cased runs of letters, in Latin-1: one byte a code point."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def _utf8(word: bytes) -> bytes:
    return word if word.isascii() else word.decode("latin-1").encode()


def _changes(doc_id: int | None, found: list[bytes], every: int) -> Iterator[tuple[bytes, bytes]]:
    """(run, what is left of it) for the runs of a document that lose a code point."""
    start = zlib.crc32(b"%s:" % (b"" if doc_id is None else b"%d" % doc_id))
    distinct = list(set(found))
    hashes = np.array([zlib.crc32(_utf8(w), start) for w in distinct], np.int64)
    for k in np.flatnonzero(hashes % every == 0):
        word = distinct[k]
        at = int(hashes[k]) % len(word)
        yield word, word[:at] + word[at + 1 :]


def word_counts(
    docs: DataFrame, every: int = 97, least: int = 5, often: int = 3, held_words: int = HELD_WORDS
) -> DataFrame:
    """(word, n): words of ``least`` code points or more that occur ``often`` or more.

    A run of a document loses one code point if ``every`` divides the CRC32 of "<doc_id>:<run>".
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def counted() -> pa.RecordBatch:
            held = [(w.decode("latin-1"), n) for w, n in total.items() if n and len(w) >= least]
            total.clear()
            return common.record_batch(
                word=pa.array([w for w, _ in held], pa.string()), n=pa.array([n for _, n in held], pa.int64())
            )

        size = 0
        for batch in common.bounded(batches):
            every_run: list[bytes] = []
            change: Counter[bytes] = Counter()
            for doc_id, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                found = runs(text or "")
                changed = list(_changes(doc_id, found, every))
                if changed:
                    times = Counter(found)
                    for word, left in changed:
                        change[word] -= times[word]
                        change[left] += times[word]
                every_run += found
            total.update(every_run)
            for word, n in change.items():
                total[word] += n
            size += sum(map(len, every_run))
            if len(total) > held_words or size > HELD_BYTES and sum(map(len, total)) > HELD_BYTES:
                yield counted()
            size = size if size <= HELD_BYTES else 0
        yield counted()

    common.prepare(docs.sparkSession)
    parts = common.documents(docs, "text").mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= often)


@lru_cache(1 << 12)
def damaged(length: int) -> list[tuple[int, int]]:
    """The parts of a word of which an edit damages one at most, each (from, to)."""
    parts = {(0, length)}
    for _ in range(CUTS):
        cut = set()
        for start, end in parts:
            half = (end - start) // 2
            cut |= {(start, end)} if end - start <= LEAF else {(start + half, end), (start, end - half)}
        parts = cut
    return sorted(parts)


def _keys(word: bytes, length: int) -> list[int]:
    """A hash of what stands around each part that may be damaged, for partners of ``length``."""
    more = len(word) - length
    digest = xxhash.xxh64_intdigest
    return [
        digest(b"%d,%d," % (length, start) + word[:start] + b" " + word[end + more :]) - (1 << 63)
        for start, end in damaged(length)
    ]


def _emitted(words: DataFrame, shifted: bool) -> DataFrame:
    """(key, word, n): chunks of each word, or grams of each word for partners one shorter."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, rows = [], []
        for i, text in enumerate(batch.column("word").to_pylist()):
            word = text.encode("latin-1")
            own = _keys(word, len(word) - shifted)
            keys += own
            rows += [i] * len(own)
        picked = pa.array(rows, pa.int64())
        return common.record_batch(
            key=pa.array(keys, pa.int64()), word=batch.column("word").take(picked), n=batch.column("n").take(picked)
        )

    return common.map_batches(words, run, "key long, word string, n long", "word")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, an, b, bn): each pair of near words once, with their counts."""
    chunks = _emitted(words, False).select("key", F.col("word").alias("a"), F.col("n").alias("an"))
    same = _emitted(words, False).withColumn("longer", F.lit(False))
    grams = same.unionAll(_emitted(words, True).withColumn("longer", F.lit(True))).select(
        "key", F.col("word").alias("b"), F.col("n").alias("bn"), "longer"
    )
    met = chunks.join(unsent(grams), "key").filter(
        (F.col("longer") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)
    )
    return met.groupBy("a", "b").agg(F.first("an").alias("an"), F.first("bn").alias("bn"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words of (word, form): forms followed to the last, by doubling.

    The count at least doubles from a word to its form, so rounds are few and there is no circle.
    """
    links = forms.select("word", F.col("form").alias("root"))
    while True:
        links = common.stored(links, "spelling-roots")
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = links.join(unsent(further), "root", "left")
        if stepped.filter(F.col("next").isNotNull()).isEmpty():
            return links
        links = stepped.select("word", F.coalesce("next", "root").alias("root"))


def variants(docs: DataFrame, every: int = 97, least: int = 5, often: int = 3, factor: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of the documents.

    The form is the near word of largest count (of several, the first in code-point order), if it
    is at least ``factor`` times the word's own.
    """
    words = common.stored(word_counts(docs, every, least, often), "spelling-words")
    pairs = common.stored(near_pairs(words), "spelling-pairs")
    best = F.struct((-F.col("bn")).alias("less"), F.col("b").alias("form"))
    both = pairs.select("a", "an", "b", "bn").unionAll(
        pairs.select(F.col("b"), F.col("bn"), F.col("a"), F.col("an"))
    )
    near = both.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.first("an").alias("own"), F.min(best).alias("best")
    )
    clear = -F.col("best.less") >= factor * F.col("own")
    formed = common.stored(
        near.select(
            "word", "n_near", F.when(clear, F.col("best.form")).alias("form"),
            F.when(clear, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(formed.filter(F.col("form").isNotNull()))
    return words.join(unsent(formed), "word", "left").join(unsent(roots), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
    )
