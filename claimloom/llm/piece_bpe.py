"""SentencePiece BPE with byte fallback: encoding in vectorised merge rounds, and decoding.

A text becomes ``▁`` + text with spaces as ``▁`` (the model's identity normalisation with a dummy
prefix). It is cut where no piece of the vocabulary can reach across: before each run of ``▁``, and
around characters that no longer piece contains. The distinct new words of a batch lie in one flat
numpy array of symbols; words seen before keep their ids in another one. Each round finds the best pair of every word (least rank, leftmost among
equals) by a segmented minimum, merges all of them at once, closes the gaps and looks up the pairs
beside each merge, until no word has a pair left. One merge a word and round is exactly the
library's order, in which a new pair may precede the next occurrence of an old one.

A word of over ``LONG`` symbols would need as many rounds as merges, so it is merged with a queue
of its pairs by the same order. Characters without a piece become their UTF-8 bytes' pieces.

Defined cases: null and empty texts have no ids and decode to an empty text; decoding joins pieces,
takes ``▁`` for a space and drops the first one, and bytes that are no UTF-8 become U+FFFD each.
"""

from __future__ import annotations

import codecs
import heapq
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from . import common

SPACE = "▁"
LONG, CACHE = 96, 1 << 18
_NONE = np.int64(1 << 62)

#: A key for the line end, which is cut off like any character that no longer piece contains.
LINE = ("\n",)

codecs.register_error("each-byte", lambda e: ("�" * (e.end - e.start), e.end))


class _Known(dict):
    """Numbers words in the order they are met; ``new`` are those since it was emptied."""

    def __init__(self):
        self.new: list = []

    def __missing__(self, word) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class _Ragged:
    """Rows of different lengths in one flat array that grows."""

    def __init__(self, dtype):
        self.flat, self.starts, self.lengths = np.zeros(0, dtype), *np.zeros((2, 0), np.int64)

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, flat.astype(self.flat.dtype)])

    def take(self, rows: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chosen rows end to end, and where each group of ``per`` rows begins and the last ends."""
        lengths = self.lengths[rows]
        ends = np.cumsum(lengths)
        place = np.arange(ends[-1] if len(ends) else 0)
        place += np.repeat(self.starts[rows] - ends + lengths, lengths)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per)])]
        return self.flat[place], bounds


class Vocabulary:
    """Symbols, merges and surfaces of a model file."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) for i in range(size)]
        names = [model.id_to_piece(i) for i in range(size)]
        pieces = {p: i for i, p in enumerate(names) if not special[i]}
        self.bytes = {int(names[i][1:-1], 16): i for i in range(size) if model.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte fallback")
        #: UTF-8 of each id, nothing for control pieces.
        self.surface = [
            bytes([int(names[i][1:-1], 16)]) if model.is_byte(i)
            else b"" if model.is_control(i)
            else names[i].replace(SPACE, " ").encode()
            for i in range(size)
        ]
        self.silent = {i for i in range(size) if model.is_control(i)}
        self.drops_space = {i for i in range(size) if not special[i] and names[i].startswith(SPACE)}
        longer = [p for p in pieces if len(p) > 1]
        letters = sorted({c for p in longer for c in p})
        # Symbols are the pieces, and the characters of pieces that are none themselves.
        self.symbol = dict(pieces)
        for c in letters:
            self.symbol.setdefault(c, size + len(self.symbol))
        #: Symbol of each code point, below 0 (by code point) where there is none.
        self.letter = -np.arange(0x110000, dtype=np.int64) - 1
        singles = {ord(c): i for c, i in self.symbol.items() if len(c) == 1}
        self.letter[list(singles)] = list(singles.values())
        scores = sorted({model.get_score(i) for i in pieces.values()}, reverse=True)
        rank = {s: r for r, s in enumerate(scores)}
        self.width = max(self.symbol.values(), default=0) + 2
        merges = sorted(
            (self.symbol[p[:k]] * self.width + self.symbol[p[k:]], rank[model.get_score(i)], i)
            for p, i in pieces.items()
            for k in range(1, len(p))
            if p[:k] in self.symbol and p[k:] in self.symbol
        )
        self.keys, self.ranks, self.merged = (
            np.array(column, np.int64) for column in zip(*merges, strict=True)
        )
        self.pairs = {key: (r, m) for key, r, m in merges}
        inner = re.escape("".join(c for c in letters if c != SPACE))
        crossing = any(SPACE in p.lstrip(SPACE) for p in longer)
        self.words = re.compile(
            "(?s:.+)" if crossing else f"{SPACE}+[{inner}]*|[{inner}]+|[^{inner}{SPACE}]+"
        )
        self.cuts = not crossing
        self.cuts_lines = self.cuts and "\n" not in self.symbol
        self.texts = _Ragged(np.uint8)
        self.texts.add(
            np.frombuffer(b"".join(self.surface), np.uint8),
            np.fromiter(map(len, self.surface), np.int64, size),
        )
        self._forget()

    def _forget(self) -> None:
        #: Numbers of the words seen before (those behind a space by their text alone, others as a
        #: tuple of one), and the ids of each.
        self.known, self.known_ids = _Known(), _Ragged(np.int32)

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs; rank _NONE where there is no such piece."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], _NONE), self.merged[at]

    def _symbols(self, words: list[str]) -> np.ndarray:
        return self.letter[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]

    def _rounds(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(word, symbol) in order for every symbol left of each word after all merges."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbol = self._symbols(words)
        word = np.repeat(np.arange(len(words)), lengths)
        finished: list[tuple[np.ndarray, np.ndarray]] = []
        right = np.r_[symbol[1:], -1]
        rank, merged = self._lookup(symbol, right)
        rank[np.r_[word[1:] != word[:-1], True]] = _NONE
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            place = np.arange(len(symbol))
            best = np.minimum.reduceat(np.where(rank < _NONE, (rank << 32) | place, _NONE), starts)
            counts = np.diff(np.r_[starts, len(symbol)])
            done = np.repeat(best == _NONE, counts)
            finished.append((word[done], symbol[done]))
            at = best[best < _NONE] & 0xFFFFFFFF
            if not len(at):
                break
            symbol[at] = merged[at]
            keep = ~done
            keep[at + 1] = False
            # The end of a merged pair keeps whether a pair of the same word follows it.
            open_end = np.zeros(len(symbol), bool)
            open_end[np.r_[starts[1:], len(symbol)] - 1] = True
            open_end[at] = open_end[at + 1]
            moved = np.cumsum(keep) - 1
            new = moved[at]
            symbol, word, last = symbol[keep], word[keep], open_end[keep]
            rank, merged = rank[keep], merged[keep]
            beside = np.r_[new, new[(new > 0)] - 1]
            beside = beside[~last[beside]]
            rank[new] = _NONE
            if len(beside):
                rank[beside], merged[beside] = self._lookup(symbol[beside], symbol[beside + 1])
        where = np.concatenate([w for w, _ in finished])
        what = np.concatenate([s for _, s in finished])
        order = np.argsort(where, kind="stable")
        return where[order], what[order]

    def _queue(self, word: str) -> tuple[int, ...]:
        """The same merges for one long word, from a queue of pairs by rank and place."""
        symbol = self._symbols([word]).tolist()
        n = len(symbol)
        after, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n and symbol[i] >= 0 and symbol[after[i]] >= 0:
                key = symbol[i] * self.width + symbol[after[i]]
                if key in self.pairs:
                    heapq.heappush(heap, (self.pairs[key][0], i, key))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, key = heapq.heappop(heap)
            j = after[i] if symbol[i] is not None else n
            if j >= n or symbol[i] < 0 or symbol[i] * self.width + symbol[j] != key:
                continue
            symbol[i], symbol[j] = self.pairs[key][1], None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return self._to_ids([s for s in symbol if s is not None], word)

    def _to_ids(self, symbols, word: str) -> tuple[int, ...]:
        """Ids of symbols of which some are characters without a piece: those are spelled out."""
        letter = {v: c for c in word if (v := self.symbol.get(c, -1)) >= len(self.surface)}
        ids: list[int] = []
        for s in symbols:
            if 0 <= s < len(self.surface):
                ids.append(s)
            else:
                ids += [self.bytes[b] for b in (letter[s] if s >= 0 else chr(-s - 1)).encode()]
        return tuple(ids)

    def _learn(self, new: list) -> None:
        """Adds the ids of new words, which are distinct."""
        words = [w[0] if isinstance(w, tuple) else SPACE + w for w in new]
        short = np.array([i for i, w in enumerate(words) if len(w) <= LONG], np.int64)
        where, what = np.zeros((2, 0), np.int64)
        if len(short):
            where, what = self._rounds([words[i] for i in short])
            where = short[where]
        odd = np.unique(where[(what < 0) | (what >= len(self.surface))])
        special = {i: self._queue(w) for i, w in enumerate(words) if len(w) > LONG}
        for i in odd.tolist():
            own = slice(*np.searchsorted(where, [i, i + 1]))
            special[i] = self._to_ids(what[own].tolist(), words[i])
        # Words that need no spelling keep their symbols, which are ids.
        plain = ~np.isin(where, odd)
        where, what = where[plain], what[plain]
        more = np.array([(i, x) for i, ids in special.items() for x in ids], np.int64).reshape(-1, 2)
        where, what = np.concatenate([where, more[:, 0]]), np.concatenate([what, more[:, 1]])
        order = np.argsort(where, kind="stable")
        self.known_ids.add(what[order], np.bincount(where, minlength=len(words)))

    def _cut(self, text: str) -> list:
        """Keys of a text's words."""
        if not text:
            return []
        if not self.cuts or text[0] == " " or "  " in text or SPACE in text:
            words = self.words.findall(SPACE + text.replace(" ", SPACE))
            return [w[1:] if w[0] == SPACE else (w,) for w in words]
        if not self.cuts_lines or "\n" not in text:
            return text.split(" ")
        # Without runs of spaces, cutting at spaces and line ends is the same, and much cheaper.
        first, *lines = text.split("\n")
        words = first.split(" ")
        for line in lines:
            start, *rest = line.split(" ")
            words.append(LINE)
            if start:
                words.append((start,))
            words += rest
        return words

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text begins and the last ends."""
        if len(self.known) > CACHE:
            self._forget()
        cut = [self._cut(t) for t in texts]
        per = np.fromiter(map(len, cut), np.int64, len(cut))
        number = self.known.__getitem__
        rows = np.fromiter(map(number, chain.from_iterable(cut)), np.int64, int(per.sum()))
        if self.known.new:
            self._learn(self.known.new)
            self.known.new = []
        return self.known_ids.take(rows, per)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        ids, bounds = self.encode_flat(texts)
        flat, bounds = ids.tolist(), bounds.tolist()
        return [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def decode_flat(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The text of each run of ids."""
        raw, ends = self.texts.take(ids, np.diff(bounds))
        raw, ends, bounds = raw.tobytes(), ends.tolist(), bounds.tolist()
        silent = np.isin(ids, list(self.silent))
        out = []
        for i in range(len(bounds) - 1):
            own = ids[bounds[i] : bounds[i + 1]]
            if silent[bounds[i] : bounds[i + 1]].any():
                out.append(self._with_control(own.tolist()))
                continue
            drop = len(own) and int(own[0]) in self.drops_space
            out.append(raw[ends[i] + drop : ends[i + 1]].decode("utf-8", "each-byte"))
        return out

    def decode(self, ids: list[int]) -> str:
        return self.decode_flat(np.array(ids, np.int64), np.array([0, len(ids)]))[0]

    def _with_control(self, ids: list[int]) -> str:
        """Control pieces have no text, but bytes before and after one are no character."""
        runs: list[list[int]] = [[]]
        for i in ids:
            if i in self.silent:
                runs.append([])
            else:
                runs[-1].append(i)
        runs = [r for r in runs if r]
        raw = [b"".join(map(self.surface.__getitem__, r)) for r in runs]
        if runs and runs[0][0] in self.drops_space:
            raw[0] = raw[0][1:]
        return "".join(r.decode("utf-8", "each-byte") for r in raw)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary and its known words for each Python worker."""
    return Vocabulary(path)


def _lists(ids: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids end to end and bounds of a column of lists; null is an empty list."""
    sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)])


def _whole(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def _with(df: DataFrame, **more) -> StructType:
    return StructType([*df.schema.fields, *(StructField(n, kind) for n, kind in more.items())])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with a column ``ids``: the ids of each whole text (none for null)."""
    schema = _with(docs.drop("ids"), ids=ArrayType(IntegerType()))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.append_column("ids", _lists(*vocabulary(path).encode_flat(_whole(batch))))

    return common.map_batches(docs.drop("ids"), run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with a column ``decoded``: the text of ``ids``."""
    schema = _with(encoded.drop("decoded"), decoded=StringType())

    def run(batches):
        for batch in batches:
            texts = vocabulary(path).decode_flat(*_flat(batch.column("ids")))
            yield batch.append_column("decoded", pa.array(texts, pa.string()))

    common.prepare(encoded.sparkSession)
    return encoded.drop("decoded").mapInArrow(run, schema)


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids`` and their ``decoded`` text, in one pass through one worker a task."""
    read = docs.drop("ids", "decoded")
    schema = _with(read, ids=ArrayType(IntegerType()), decoded=StringType())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = vocabulary(path)
        ids, bounds = words.encode_flat(_whole(batch))
        texts = pa.array(words.decode_flat(ids, bounds), pa.string())
        return batch.append_column("ids", _lists(ids, bounds)).append_column("decoded", texts)

    return common.map_batches(read, run, schema)


def digest(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of rows with ``ids`` and ``decoded``."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
