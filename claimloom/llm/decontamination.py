"""Benchmark decontamination by Wu-Manber search for many strings at once.

Texts are lower-cased (A-Z) and cut into words of letters and digits; a text becomes its words, each
with a blank before it and one blank behind the last. A window of an item is ``window`` consecutive
words in the same form (an item of fewer words is one window), so that windows are plain strings and
an occurrence of one begins and ends between words.

Windows are sorted into classes of similar length; a class looks at the first ``least`` bytes of its
windows. For each block of ``width`` bytes the shift table says how far the search may go on without
passing the start of a window (``least - width + 1`` where no window has the block). Where that is
zero, the windows whose block at ``least`` and first block hash alike form a bucket, and each of its
windows is compared with the text, byte by byte. The search runs in lockstep over many stretches of a
batch of texts, as arrays.

The strings of one search hold ``BLOCK_BYTES`` of item text at most, which bounds the tables that tasks
get. A larger benchmark is searched for block by block, each in a pass of its own over the documents,
and what the passes found is joined by row; nothing is dropped.

Defined cases: null texts have no words; rows that share an item_id are one item; items without an id
mark words but are not counted or listed; an item without words never occurs; repeated documents are
returned as often as they come; no items leave all documents clean.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Words of a window; item text of one search; words of an item that are dealt together.
WINDOW, BLOCK_BYTES, STRETCH = 10, 4 << 20, 4096
#: Bytes of a block at most, bits of a shift table, stretches that are searched in lockstep.
WIDTH, TABLE_BITS, LANES = 8, 20, 4096
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _letters() -> bytes:
    """Digits, letters in lower case and all bytes beyond ASCII stay, others become blanks."""
    kept = np.full(256, 32, np.uint8)
    for first, last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        kept[first : last + 1] = np.arange(first, last + 1)
    kept[0x41:0x5B] = kept[0x61:0x7B]
    return kept.tobytes()


_LETTERS = _letters()


def words(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def _at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a number; ``data`` has seven more bytes at its end."""
    return np.ndarray((max(len(data) - 7, 0),), "<u8", data, strides=(1,))


def _mask(width: int | np.ndarray) -> np.ndarray:
    bits = np.minimum(np.asarray(width), 8).astype(np.uint64) * np.uint64(8)
    return np.where(bits >= 64, ~np.uint64(0), (np.uint64(1) << (bits % np.uint64(64))) - np.uint64(1))


def _slot(block: np.ndarray) -> np.ndarray:
    return ((block * _ODD) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


@dataclass
class _Class:
    """Windows of similar length, in the order of their bucket keys."""

    least: int
    width: int
    shifts: np.ndarray
    keys: np.ndarray
    order: np.ndarray

    def key(self, block: np.ndarray, head: np.ndarray) -> np.ndarray:
        return ((block * _ODD) ^ ((head + np.uint64(1)) * _MIX)).astype(np.uint64)


class Search:
    """Tables of a set of windows: ``texts`` are their strings, ``counts`` the words of each."""

    def __init__(self, texts: list[bytes], counts: list[int]):
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.counts = np.array(counts, np.int64)
        self.data = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
        grams, self.classes = _at(self.data), []
        sizes = np.frexp(self.lengths.astype(float))[1]
        for size in np.unique(sizes):
            of = np.flatnonzero(sizes == size)
            least = int(self.lengths[of].min())
            width = max(min(WIDTH, least, max(3, least // 2)), 1)
            mask = _mask(width)
            shifts = np.full(1 << TABLE_BITS, least - width + 1, np.int32)
            # From the first block to the last, so that the least shift of a block stays.
            for end in range(width, least + 1):
                shifts[_slot(grams[self.starts[of] + end - width] & mask)] = least - end
            made = _Class(least, width, shifts, np.zeros(0, np.uint64), of)
            keys = made.key(grams[self.starts[of] + least - width] & mask, grams[self.starts[of]] & mask)
            order = np.argsort(keys, kind="stable")
            made.keys, made.order = keys[order], of[order]
            self.classes.append(made)

    def find(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, windows) of all occurrences; ``data`` has eight more bytes at its end."""
        grams, found = _at(data), []
        for group in self.classes:
            places, windows = self._candidates(group, grams, len(data) - 8)
            found.append(self._confirmed(grams, len(data) - 8, places, windows))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _candidates(self, group: _Class, grams: np.ndarray, size: int):
        """Places where a window of the bucket may begin."""
        last = size - group.least
        if last < 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        step = -(-(last + 1) // LANES)
        at = np.arange(0, last + 1, step)
        ends = np.minimum(at + step, last + 1)
        mask, behind, stops = _mask(group.width), group.least - group.width, []
        while len(at):
            shift = group.shifts[_slot(grams[at + behind] & mask)]
            stops.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            on = at < ends
            at, ends = at[on], ends[on]
        places = np.concatenate(stops)
        keys = group.key(grams[places + behind] & mask, grams[places] & mask)
        low = np.searchsorted(group.keys, keys, "left")
        many = np.searchsorted(group.keys, keys, "right") - low
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(places, many), group.order[np.repeat(low, many) + nth]

    def _confirmed(self, grams: np.ndarray, size: int, places: np.ndarray, windows: np.ndarray):
        own, on = _at(self.data), places + self.lengths[windows] <= size
        places, windows, done = places[on], windows[on], 0
        while True:
            left = self.lengths[windows] - done
            live = np.flatnonzero(left > 0)
            if not len(live):
                return places, windows
            differ = grams[places[live] + done] ^ own[self.starts[windows[live]] + done]
            wrong = live[(differ & _mask(left[live])) != 0]
            keep = np.ones(len(places), bool)
            keep[wrong] = False
            places, windows, done = places[keep], windows[keep], done + 8


@dataclass
class Items:
    """One block of the benchmark: its search, and the items of each window (as a sorted list)."""

    search: Search
    names: list[str]
    #: Items of window w: ``owners[edges[w] : edges[w + 1]]``.
    owners: np.ndarray
    edges: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[list[str], str]], window: int) -> Items:
        """``rows``: (ids, words joined by a blank) of each stretch."""
        names = sorted({i for ids, _ in rows for i in ids})
        number = {n: k for k, n in enumerate(names)}
        found: dict[bytes, tuple[int, set[int]]] = {}
        for ids, text in rows:
            split = text.encode().split()
            own = {number[i] for i in ids}
            for k in range(max(len(split) - window, 0) + 1):
                part = split[k : k + window]
                found.setdefault(b" " + b" ".join(part) + b" ", (len(part), set()))[1].update(own)
        owners = [sorted(of) for _, of in found.values()]
        edges = np.cumsum([0, *map(len, owners)])
        flat = np.array([i for of in owners for i in of], np.int64)
        return cls(Search(list(found), [n for n, _ in found.values()]), names, flat, edges)

    def occurrences(self, texts: list[bytes]) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
        """(words, hit ranges of words, items) of each text."""
        split = [words(t) for t in texts]
        data = b"\n".join(b" " + b" ".join(w) + b" " if w else b" " for w in split)
        buffer = np.frombuffer(data + bytes(8), np.uint8)
        places, windows = self.search.find(buffer)
        blanks = np.flatnonzero(buffer == 32)
        # A text has a blank for each word and one more.
        firsts = np.cumsum([0, *(len(w) + 1 for w in split)])
        slots = np.searchsorted(blanks, places)
        change = np.zeros(len(blanks) + 1, np.int64)
        np.add.at(change, slots, 1)
        np.add.at(change, slots + self.search.counts[windows], -1)
        hit = np.diff((np.cumsum(change) > 0).astype(np.int8), prepend=0)
        opens, closes = np.flatnonzero(hit == 1), np.flatnonzero(hit == -1)
        owner = np.searchsorted(firsts, slots, "right") - 1
        pairs = np.unique(np.stack([owner, windows]), axis=1) if len(owner) else np.zeros((2, 0), np.int64)
        cuts = np.searchsorted(pairs[0], np.arange(len(split) + 1))
        from_, to = np.searchsorted(opens, firsts[:-1]), np.searchsorted(opens, firsts[1:])
        for i, own in enumerate(split):
            ranges = [
                (int(a - firsts[i]), int(b - firsts[i]))
                for a, b in zip(opens[from_[i] : to[i]], closes[from_[i] : to[i]], strict=True)
            ]
            of: set[int] = set()
            for w in pairs[1, cuts[i] : cuts[i + 1]]:
                of.update(self.owners[self.edges[w] : self.edges[w + 1]].tolist())
            yield len(own), ranges, [self.names[k] for k in sorted(of)]


def _stretches(benchmark: DataFrame, window: int, stretch: int) -> DataFrame:
    """(text, items): distinct stretches of ``stretch`` windows at most, with the items that have them."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, texts = [], []
        for item, text in zip(batch.column("item_id").to_pylist(), common.texts(batch), strict=True):
            split = words(text)
            for at in range(0, max(len(split) - window + 1, min(len(split), 1)), stretch):
                ids.append(item)
                texts.append(b" ".join(split[at : at + stretch + window - 1]).decode())
        return common.record_batch(item_id=pa.array(ids, pa.string()), text=pa.array(texts, pa.string()))

    read = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    cut = common.map_batches(read, run, "item_id string, text string")
    return cut.groupBy("text").agg(F.collect_set("item_id").alias("items"))


def _searched(docs: DataFrame, items: Items, key: str, count: bool) -> DataFrame:
    """(key, n_words, ranges, items) of each row, or of each row that has an occurrence."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = list(items.occurrences(common.texts(batch)))
        rows = [i for i, (_, ranges, _) in enumerate(found) if count or ranges]
        return common.record_batch(
            **{key: batch.column(key).take(pa.array(rows, pa.int64()))},
            n_words=pa.array([found[i][0] for i in rows], pa.int64()),
            ranges=pa.array([[{"first": a, "last": b} for a, b in found[i][1]] for i in rows], _RANGES),
            items=pa.array([found[i][2] for i in rows], pa.list_(pa.string())),
        )

    return common.map_batches(docs, run, f"{key} long, n_words long, ranges {RANGES}, items array<string>")


RANGES = "array<struct<first: long, last: long>>"
_RANGES = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def occurrences(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, key: str = "doc_id",
    block_bytes: int = BLOCK_BYTES, stretch: int = STRETCH,
) -> DataFrame:
    """(key, n_words, ranges, items) for each row of ``docs``, which has the columns ``key`` and text.

    ``ranges`` are the hit words, from ``first`` (from 0) to before ``last``; ``items`` the sorted ids of
    items with an occurring window.
    """
    spark = docs.sparkSession
    stretches = common.stored(_stretches(benchmark, window, stretch), "benchmark")
    weight = F.octet_length("text") + F.coalesce(
        F.aggregate("items", F.lit(0).cast("long"), lambda s, i: s + F.octet_length(i) + 8), F.lit(0)
    )
    total = stretches.agg(F.sum(weight)).first()[0] or 0
    blocks = max(1, math.ceil(2 * total / block_bytes))
    if total <= block_bytes:
        blocks = 1
    block = F.pmod(F.xxhash64("text"), F.lit(blocks))

    def items(number: int) -> Items:
        rows = stretches.filter(block == number).select("items", "text").collect()
        return Items.of([(r.items, r.text) for r in rows], window)

    read = docs.select(F.col(key).cast("long").alias(key), "text")
    if blocks == 1:
        return _searched(read, items(0), key, True)
    rows = common.stored(read.withColumn("_row", F.monotonically_increasing_id()), "search-rows")
    # The driver holds the tables of one block at a time.
    passes = [
        common.stored(_searched(rows.select("_row", "text"), items(k), "_row", k == 0), f"search-{k}")
        for k in range(blocks)
    ]
    every = passes[0]
    for more in passes[1:]:
        every = every.unionAll(more)
    joined = every.groupBy("_row").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("ranges"))).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return rows.select("_row", key).join(joined, "_row").drop("_row")


def n_hit() -> Column:
    """Words in ``ranges``, which may overlap but are sorted."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        "ranges", start,
        lambda s, r: F.struct(
            F.greatest(s["at"], r["last"]).alias("at"),
            (s["n"] + F.greatest(F.lit(0).cast("long"), r["last"] - F.greatest(s["at"], r["first"]))).alias("n"),
        ),
        lambda s: s["n"],
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, columns unchanged."""
    rows = common.stored(
        docs.select(F.monotonically_increasing_id().alias("_row"), F.struct("*").alias("row")), "rows"
    )
    read = rows.select("_row", F.col("row.text").alias("text"))
    found = occurrences(read, benchmark, window, "_row").filter(F.size("ranges") > 0)
    return rows.join(found.select("_row"), "_row", "left_anti").select("row.*")
