"""Substring dedup: removes words of word windows that occur more than once in the corpus.

The matching is done by compressed FM-indexes, one per shard (see ``fm_index``). Shards are made so
that equal windows always meet, and nothing else has to:

1. Every window's *minimizer* is the least hash among its ``GRAM``-word runs. Equal windows have
   equal minimizers, so a window can only repeat if its minimizer occurs at two places. Documents
   report the places they chose (about 8 in 100 words) by hash alone.
2. Documents with a repeated minimizer are cut into segments: at most ``WINDOW - GRAM + 1`` consecutive
   windows of one such minimizer, with all their words. Equal segments are collapsed to one with
   a count.
3. A shard takes the segments of some minimizers, about ``SHARD_WORDS`` words. It indexes them, those
   that came more than once twice, and streams each segment through backward search; windows that
   occur twice are reported. Words are
   compared as they are, hashes only decide who meets. A minimizer with more words than a shard
   holds is cut into chunks, and a grid of tasks matches every chunk against every other.
4. Reported windows go back to the places their segments came from; words they cover are removed.

A text is known by two 64-bit hashes, so equal texts share one answer and rows need no id.

Defined cases: null text has no words; texts of fewer words than a window lose nothing; equal texts of a
window or more lose all; a window that overlaps its own repetition counts; repeated rows and
rows without doc_id are rows like others; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .fm_index import FmIndex, repeated_windows

WINDOW, GRAM = 35, 12
SHARD_WORDS = 1_000_000
#: Distinct segments a task holds before it hands them on.
HELD = 20_000
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def _spread(hashes: np.ndarray) -> np.ndarray:
    hashes = hashes * np.uint64(0xBF58476D1CE4E5B9)
    return hashes ^ (hashes >> np.uint64(31))


def _over(values: np.ndarray, width: int, function: np.ufunc) -> np.ndarray:
    """Least or greatest of each ``width`` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        values = function(values[:-have], values[have:])
        have *= 2
    if have < width:
        rest = width - have
        values = function(values[:-rest], values[rest:])
    return values


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words, by doubling."""
    parts, length, out, covered = words, 1, None, 0
    n = len(words) - size + 1
    remaining = size
    while True:
        if remaining & 1:
            piece = parts[covered : covered + n]
            out = piece.copy() if out is None else _spread(out * _MULTIPLY + piece)
            covered += length
        remaining >>= 1
        if not remaining:
            return _spread(out)
        parts = _spread(parts[:-length] * _MULTIPLY + parts[length:])
        length *= 2


def _minimizers(hashes: np.ndarray, window: int, gram: int):
    """(hashes of grams, minimizer of each window) of the words of a text of a window or more."""
    grams = _grams(hashes, gram)
    return grams, _over(grams, window - gram + 1, np.minimum)


def _chosen(grams: np.ndarray, least: np.ndarray, reach: int) -> np.ndarray:
    """Minimizers once for each place that holds one, twice at most for each value."""
    padded = np.concatenate([np.zeros(reach - 1, np.uint64), least, np.zeros(reach - 1, np.uint64)])
    values, counts = np.unique(grams[grams == _over(padded, reach, np.maximum)], return_counts=True)
    return np.repeat(values, np.minimum(counts, 2))


def _digests(docs: DataFrame, *columns) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        *columns, F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"), "text"
    )


def _first_pass(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc_id, k1, k2, n_words, all_sha256, minimizers): what each row has if nothing is removed."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, found = [], [], []
        for text in common.texts(batch):
            words = text.split()
            counts.append(len(words))
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            if len(words) < window:
                found.append(None)
            else:
                grams, least = _minimizers(common.word_hashes(text), window, gram)
                found.append(_chosen(grams, least, window - gram + 1).view(np.int64))
        return common.record_batch(
            doc_id=batch.column("doc_id"), k1=batch.column("k1"), k2=batch.column("k2"),
            n_words=pa.array(counts, pa.int64()), all_sha256=pa.array(digests, pa.string()),
            minimizers=pa.array(found, pa.list_(pa.int64())),
        )

    schema = (
        "doc_id long, k1 long, k2 long, n_words long, all_sha256 string, minimizers array<long>"
    )
    rows = _digests(docs, F.col("doc_id").cast("long").alias("doc_id"))
    return common.map_batches(rows, run, schema)


def _repeated(first: DataFrame) -> DataFrame:
    """(k1, minimizers): for each text its minimizers that occur at two places or more."""
    places = first.select("k1", F.explode("minimizers").alias("value"))
    # Counted before they are shuffled, so a value in every text is no single task's work; Spark can split
    # the join that follows.
    repeated = places.groupBy("value").agg(F.count("*").alias("n")).filter("n > 1").select("value")
    return (
        places.join(repeated, "value")
        .groupBy("k1")
        .agg(F.collect_set("value").alias("minimizers"))
    )


def _cut(text: bytes, repeated: list[int], window: int, gram: int):
    """(words, minimizer, first word, windows) of a text's segments."""
    words = text.split()
    if len(words) < window:
        return words, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, least = _minimizers(common.word_hashes(text), window, gram)
    least = least.view(np.int64)
    inside = np.isin(least, np.array(repeated, np.int64))
    turn = np.concatenate([[True], (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])])
    starts = np.flatnonzero(turn)
    ends = np.concatenate([starts[1:], [len(least)]])
    keep = inside[starts]
    starts, ends = starts[keep], ends[keep]
    most = window - gram + 1
    parts = -(-(ends - starts) // most)
    run = np.repeat(np.arange(len(starts)), parts)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = starts[run] + nth * most
    return words, least[begin], begin, np.minimum(ends[run] - begin, most)


def _key(segment: bytes) -> tuple[int, int]:
    """The segment's name: 128 bits of hash as two signed longs."""
    low, high = np.frombuffer(xxhash.xxh3_128_digest(segment), np.int64).tolist()
    return low, high


def _touched(docs: DataFrame, repeated: DataFrame, window: int, gram: int) -> DataFrame:
    """(k1, k2, text, copies, segments) of the texts with repeated minimizers.

    The join sorts equal texts next to each other; those of one batch become one row, so even a
    very large group of copies leaves few rows.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), strict=True)
        places: dict[tuple[int, int], list[int]] = {}
        for i, key in enumerate(keys):
            places.setdefault(key, []).append(i)
        copies = [len(own) for own in places.values()]
        batch = batch.take(pa.array([own[0] for own in places.values()], pa.int32()))
        every = []
        for text, repeated in zip(
            common.texts(batch), batch.column("minimizers").to_pylist(), strict=True
        ):
            words, value, begin, windows = _cut(text, repeated, window, gram)
            found = []
            for v, b, n in zip(value.tolist(), begin.tolist(), windows.tolist(), strict=True):
                h1, h2 = _key(b" ".join(words[b : b + n + window - 1]))
                found.append({"value": v, "begin": b, "windows": n, "h1": h1, "h2": h2})
            every.append(found)
        kind = pa.list_(
            pa.struct([(c, pa.int64()) for c in ("value", "begin", "windows", "h1", "h2")])
        )
        return common.record_batch(
            k1=batch.column("k1"), k2=batch.column("k2"), text=batch.column("text"),
            copies=pa.array(copies, pa.int64()), segments=pa.array(every, kind),
        )

    rows = _digests(docs).join(repeated, "k1").select("k1", "k2", "text", "minimizers")
    segment = "struct<value: long, begin: long, windows: long, h1: long, h2: long>"
    return common.map_batches(
        rows, run, f"k1 long, k2 long, text string, copies long, segments array<{segment}>"
    )


def _segments(touched: DataFrame, window: int) -> DataFrame:
    """(value, h1, h2, windows, words, n): segments with their words, collapsed within a task."""

    def run(batches):
        held: dict[tuple[int, int], list] = {}

        def rows():
            names = ("value", "h1", "h2", "windows", "words", "n")
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())
            out = [(v, h1, h2, w, words, n) for (h1, h2), (v, w, words, n) in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names
            )

        for batch in common.bounded(batches):
            for text, copies, segments in zip(
                common.texts(batch), batch.column("copies").to_pylist(),
                batch.column("segments").to_pylist(), strict=True,
            ):
                words = text.split() if segments else []
                for s in segments:
                    known = held.get((s["h1"], s["h2"]))
                    if known:
                        known[3] += copies
                        continue
                    part = words[s["begin"] : s["begin"] + s["windows"] + window - 1]
                    held[s["h1"], s["h2"]] = [
                        s["value"], s["windows"], b" ".join(part).decode(), copies
                    ]
                    if len(held) >= HELD:
                        yield rows()
        if held:
            yield rows()

    return touched.select("text", "copies", "segments").mapInArrow(
        run, "value long, h1 long, h2 long, windows long, words string, n long"
    )


def _search(words, windows, indexed, asks, names, window: int) -> list[tuple]:
    """(name, first window, last window) of what the asking segments share with indexed ones."""
    numbers: dict[str, int] = {}
    symbols, lengths = [], []
    for segment in words:
        split = segment.split(" ")
        symbols += [numbers.setdefault(w, len(numbers) + 1) for w in split]
        symbols.append(0)
        lengths.append(len(split) + 1)
    text, lengths = np.array(symbols, np.int64), np.array(lengths)
    offset = np.cumsum(lengths) - lengths
    part = text if indexed.all() else text[np.repeat(indexed, lengths)]
    index = FmIndex(part, int(lengths.max()), len(numbers))
    found = []
    # A segment meets its own place in the index.
    for need, which in ((2, indexed), (1, ~indexed)):
        open_windows = np.where(asks & which, windows, 0)
        if open_windows.any():
            at, first, last = repeated_windows(index, text, offset, open_windows, window, need)
            found.append((names[at], first, last))
    return found


def _match(window: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        """Windows of the frame's queries that repeat among its indexed segments."""
        frame = frame.groupby(["h1", "h2"], sort=True, as_index=False).agg(
            {
                "value": "first", "windows": "first", "words": "first", "n": "sum",
                "indexed": "max", "asked": "max",
            }
        )
        windows, several = frame["windows"].to_numpy(), frame["n"].to_numpy() > 1
        indexed, asked = frame["indexed"].to_numpy(), frame["asked"].to_numpy()
        # A segment that came more than once is in the index twice, and so meets itself where it is indexed.
        twice = np.flatnonzero(several & indexed)
        rows = np.concatenate([np.arange(len(frame)), twice])
        asks = asked & (indexed | ~several)
        asks = np.concatenate([asks, np.zeros(len(twice), bool)])
        found = [(np.zeros(0, np.int64),) * 3]
        if indexed.any():
            found += _search(
                frame["words"].to_numpy()[rows], windows[rows], indexed[rows], asks, rows, window
            )
        which, first, last = (np.concatenate(c) for c in zip(*found, strict=True))
        return pd.DataFrame(
            {
                "h1": frame["h1"].to_numpy()[which], "h2": frame["h2"].to_numpy()[which],
                "first": first, "last": last,
            }
        )

    return run


def _matches(touched: DataFrame, window: int, shard_words: int) -> DataFrame:
    """(h1, h2, first, last): ranges of repeated windows of each segment."""
    places = touched.select(F.explode("segments").alias("s")).select("s.*")
    distinct = places.groupBy("value", "h1", "h2", "windows").agg(F.lit(1).alias("one"))
    sizes = common.stored(
        distinct.groupBy("value").agg(F.sum(F.col("windows") + window - 1).alias("words")),
        "substring-sizes",
    )
    total = sizes.agg(F.sum("words")).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    # Few minimizers alone exceed a shard; a stored table lets Spark see how few.
    large = common.stored(
        sizes.filter(F.col("words") > shard_words).select(
            F.col("value").alias("large"), F.ceil(F.col("words") / shard_words).alias("chunks")
        ),
        "substring-large",
    )
    segments = _segments(touched, window).join(large, F.col("value") == F.col("large"), "left")
    own = F.when(F.col("chunks").isNull(), F.lit(0)).otherwise(F.pmod("h1", "chunks")).cast("int")
    others = F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)).cast("int") - 1)

    def cells(chunk):
        """A chunk is indexed in its row of the grid and asks in its column."""

        def cell(i, j, indexed, asked):
            return F.struct(
                i.alias("i"), j.alias("j"), indexed.alias("indexed"), asked.alias("asked")
            )

        yes, no = F.lit(True), F.lit(False)
        rest = F.filter(others, lambda x: x != chunk)
        return (
            F.transform(others, lambda x: cell(chunk, x, yes, x == chunk)),
            F.transform(rest, lambda x: cell(x, chunk, no, yes)),
        )

    dealt = segments.withColumn("own", own).select(
        "value", "large", "h1", "h2", "windows", "words", "n",
        F.explode(F.concat(*cells(F.col("own")))).alias("cell"),
    )
    shard = F.when(F.col("large").isNull(), F.pmod("value", F.lit(shards)))
    return (
        dealt.select(
            shard.alias("shard"), "large", "cell.*", "value", "h1", "h2", "windows", "words", "n"
        )
        .groupBy("shard", "large", "i", "j")
        .applyInPandas(_match(window), "h1 long, h2 long, first long, last long")
        .distinct()
    )


def _kept(window: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, texts = [], [], []
        for text, ranges in zip(
            common.texts(batch), batch.column("ranges").to_pylist(), strict=True
        ):
            words = text.split()
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, [r["first"] for r in ranges], 1)
            np.add.at(change, [r["last"] + window for r in ranges], -1)
            keep = np.cumsum(change[:-1]) == 0
            kept = b" ".join(compress(words, keep))
            counts.append(len(words) - int(keep.sum()))
            digests.append(hashlib.sha256(kept).hexdigest())
            texts.append(kept.decode())
        return common.record_batch(
            k1=batch.column("k1"), k2=batch.column("k2"), n_removed=pa.array(counts, pa.int64()),
            kept_sha256=pa.array(digests, pa.string()), kept=pa.array(texts, pa.string()),
        )

    return run


def dedup_substrings(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS
) -> tuple[DataFrame, DataFrame]:
    """Rows and changed texts.

    The first has (doc_id, k1, k2, n_words, n_removed, kept_sha256) for each row of ``docs``, the second
    (k1, k2, n_removed, kept_sha256, kept) for each text that loses words, where ``kept`` are the
    remaining words joined by one space.
    """
    first = common.stored(_first_pass(docs, window, gram), "substring-first")
    repeated = _repeated(first)
    touched = common.stored(_touched(docs, repeated, window, gram), "substring-touched")
    matches = common.stored(_matches(touched, window, shard_words), "substring-matches")
    places = touched.select("k1", "k2", F.explode("segments").alias("s")).select(
        "k1", "k2", F.col("s.begin").alias("begin"), F.col("s.h1").alias("h1"), F.col("s.h2").alias("h2")
    )
    shifted = F.struct(
        (F.col("begin") + F.col("first")).alias("first"), (F.col("begin") + F.col("last")).alias("last")
    )
    ranges = (
        places.join(matches, ["h1", "h2"])
        .groupBy("k1", "k2")
        .agg(F.collect_set(shifted).alias("ranges"))
    )
    # Equal texts share their ranges, so one of each is enough.
    texts = touched.select("k1", "k2", "text").join(ranges, ["k1", "k2"])
    changed = common.stored(
        common.map_batches(
            texts, _kept(window),
            "k1 long, k2 long, n_removed long, kept_sha256 string, kept string",
        ).dropDuplicates(["k1", "k2"]),
        "substring-kept",
    )
    less = changed.select("k1", "k2", "n_removed", "kept_sha256")
    rows = first.select("doc_id", "k1", "k2", "n_words", "all_sha256").join(less, ["k1", "k2"], "left")
    return (
        rows.select(
            "doc_id", "k1", "k2", "n_words",
            F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
            F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256"),
        ),
        changed,
    )
