"""Secret scan: base patterns, and formats learned from them by grammar inference.

Base matches label credentials. From a bounded sample of them (``SAMPLE`` distinct strings of a
kind, those of least hash over all documents, of long ones the first ``LONGEST`` characters) state
merging infers one probabilistic automaton a kind, and another one from as many ordinary long
strings. Every run of 12 or more credential characters in every text is then a candidate, or what
base matches inside it leave on either side, if that has 12 or more characters. A candidate is reported,
as ``like_<kind>``, if all of these hold: it goes on and ends only where strings of the kind may do so; it is no
more surprising on its way through the kind's automaton than 99 of 100 labelled strings are in an
automaton of others; and the log likelihood of the whole string, its end included, is higher than under
the ordinary automaton by more than the shares of both in the sample demand. Base matches always stay.

The ordinary sample holds unlabelled credentials too. Its strings that a format explains better or
nearly as well as an automaton of other ordinary strings are set aside and the automaton is learned
again from the rest, until nothing changes or for ``ROUNDS`` rounds; the last rest is what ordinary
means. Where all runs of a table look like a format, nothing tells them apart and all are reported.

Defined cases: null text is empty and has no spans; without labelled strings of a kind nothing is
reported for it; positions are code points, ends exclusive; repeated rows give repeated results.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from . import common
from .grammar import ALPHABET, Automaton

# Base patterns and the least length of what they must match.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {
    "assign": (re.compile(ASSIGN, re.IGNORECASE | re.ASCII), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}
# End of fixed values.
#: Longest runs only are tried for hex: shorter ones fail anyway, and none overlaps another.
LONG_HEX = re.compile(r"[0-9a-f]{16,}")
LEAST = 12
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_.=-]{{{LEAST},}}")
#: Marks between credentials that are written as one run.
JOINTS = "+/_.=-"
KINDS = [*BASE, *(f"like_{k}" for k in BASE)]
ORDINARY = "ordinary"
SAMPLE = 600
#: Sampled strings stand for themselves up to this length and are open-ended heads beyond; scored
#: ones are whole. Results of longer strings are not kept for their repeats.
LONGEST = 256
#: Rounds of setting strings aside, and the least strings an automaton of ordinary ones is cut to.
ROUNDS, LEAST_ORDINARY = 10, 50
#: Strings that are ordinary by a lesser log likelihood ratio than this are set aside as well.
DOUBT = 3.0

Span = tuple[str, int, int]


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, credential) of the base matches."""
    found = []
    for kind, (pattern, group, least) in BASE.items():
        for match in (LONG_HEX if kind == "hex" else pattern).finditer(text):
            if len(match[group]) >= least:
                found.append((kind, match.start(), match.end(), match[group]))
    return found


def candidates(text: str, base: list[tuple[str, int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """What base matches leave of the runs of credential characters, 12 or more characters each."""
    taken = sorted((start, end) for _, start, end, _ in base)
    at, free = 0, 0
    for match in CANDIDATE.finditer(text):
        # Everything before ``free`` is taken or done.
        free = max(free, match.start())
        while at < len(taken) and taken[at][0] < match.end():
            start, end = taken[at]
            if start - free >= LEAST:
                yield free, start, text[free:start]
            free, at = max(free, end), at + 1
        if match.end() - free >= LEAST:
            yield free, match.end(), text[free : match.end()]


def bare(start: int, end: int, string: str, edges: set[int]) -> tuple[int, int, str]:
    """A candidate without the marks that joined it to base matches, which begin or end at ``edges``."""
    first = len(string) - len(string.lstrip(JOINTS)) if start in edges else 0
    last = len(string.rstrip(JOINTS)) if end in edges else len(string)
    if last - first < LEAST:
        return start, end, string
    return start + first, start + last, string[first:last]


@dataclass
class Model:
    formats: dict[str, Automaton] = field(default_factory=dict)
    ordinary: Automaton | None = None
    #: Most surprise and least log likelihood ratio of a string for each kind.
    limits: dict[str, tuple[float, float]] = field(default_factory=dict)
    _known: dict[str, str | None] = field(default_factory=dict, repr=False)

    def kind(self, string: str) -> str | None:
        """The most likely format that accepts the string, if any."""
        if len(string) > LONGEST:
            return self._kind(string)
        if string not in self._known:
            if len(self._known) > 1 << 17:
                self._known.clear()
            self._known[string] = self._kind(string)
        return self._known[string]

    def _kind(self, string: str) -> str | None:
        usual, best = _usual(self.ordinary, string), []
        for kind, automaton in self.formats.items():
            likely, surprise, fits = automaton.judge(string)
            most, odds = self.limits[kind]
            if fits and surprise <= most and likely - usual > odds:
                best.append((likely, kind))
        return max(best)[1] if best else None


def _sample(docs: DataFrame, size: int) -> dict[str, list[str]]:
    """Strings of each kind and ordinary candidates with the least hashes over all documents."""

    def least(batches):
        heaps: dict[str, list[tuple[int, str]]] = {k: [] for k in (*BASE, ORDINARY)}
        held: dict[str, set[str]] = {k: set() for k in heaps}

        def offer(kind: str, string: str) -> None:
            string = string[:LONGEST]
            item = (-xxhash.xxh64_intdigest(string, 7), string)
            heap, known = heaps[kind], held[kind]
            if string in known or (len(heap) == size and item <= heap[0]):
                return
            known.add(string)
            if len(heap) < size:
                heapq.heappush(heap, item)
            else:
                known.discard(heapq.heappushpop(heap, item)[1])

        for batch in common.bounded(batches):
            for text in batch.column("text").to_pylist():
                if text:
                    base = base_spans(text)
                    for kind, _, _, string in base:
                        offer(kind, string)
                    edges = {p for s in base for p in s[1:3]}
                    for found in candidates(text, base):
                        offer(ORDINARY, bare(*found, edges)[2])
        rows = [(k, s, -h - (1 << 63)) for k, heap in heaps.items() for h, s in heap]
        if rows:
            kinds, strings, hashes = zip(*rows, strict=True)
            yield common.record_batch(
                kind=pa.array(kinds, pa.string()), string=pa.array(strings, pa.string()),
                hash=pa.array(hashes, pa.int64()),
            )

    common.prepare(docs.sparkSession)
    found = common.stored(
        docs.select("text").mapInArrow(least, "kind string, string string, hash long"), "secret-sample"
    )
    return {
        kind: [
            r.string
            for r in found.filter(found.kind == kind).select("hash", "string").distinct()
            .orderBy("hash", "string").limit(size).collect()
        ]
        for kind in (*BASE, ORDINARY)
    }


def _usual(ordinary: Automaton | None, string: str) -> float:
    """Log likelihood as an ordinary string; all symbols are alike where none is known."""
    return ordinary.score(string) if ordinary else -math.log(ALPHABET + 1) * (len(string) + 1)


def _unseen_surprises(labelled: list[str]) -> list[float]:
    """Surprise of labelled strings in automata of the other half: what a new string may expect."""
    halves = labelled[::2], labelled[1::2]
    if not halves[1]:
        return [Automaton(labelled, longest=LONGEST).judge(s)[1] for s in labelled]
    learned = [Automaton(half, longest=LONGEST) for half in halves[::-1]]
    return [a.judge(s)[1] for a, half in zip(learned, halves, strict=True) for s in half]


def _explained(strings: list[str], automaton: Automaton, most: float, labelled: int) -> set[str]:
    """Strings of the ordinary sample that fit the format and that other ordinary ones do not explain
    clearly better.

    A string is judged by an automaton that did not see it, learned from no more strings than half
    of the ``labelled`` ones: else credentials in the sample would explain themselves.
    """
    likely = {}
    for s in strings:
        value, surprise, fits = automaton.judge(s)
        if fits and surprise <= most:
            likely[s] = value
    held, aside = max(labelled // 2, LEAST_ORDINARY), set()
    for _ in range(ROUNDS if likely else 0):
        found = set()
        for fold in (0, 1):
            others = [s for s in strings[1 - fold :: 2] if s not in aside][:held]
            ordinary = Automaton(others, longest=LONGEST) if others else None
            found |= {
                s for s in strings[fold::2]
                if s in likely and likely[s] - _usual(ordinary, s) > -DOUBT
            }
        if found == aside:
            break
        aside = found
    return aside


def train(strings: dict[str, list[str]]) -> Model:
    model = Model()
    usual = strings.get(ORDINARY, [])
    aside: dict[str, set[str]] = {}
    for kind in BASE:
        if labelled := strings.get(kind):
            model.formats[kind] = automaton = Automaton(labelled, longest=LONGEST)
            most = sorted(_unseen_surprises(labelled))[-1 - len(labelled) // 100]
            aside[kind] = _explained(usual, automaton, most, len(labelled))
            model.limits[kind] = (most, 0.0)
    if rest := [s for s in usual if not any(s in found for found in aside.values())]:
        model.ordinary = Automaton(rest, longest=LONGEST)
    for kind, found in aside.items():
        odds = math.log((len(rest) + 1) / (len(found) + 1))
        model.limits[kind] = (model.limits[kind][0], max(0.0, odds))
    return model


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """The automata of the formats, from a sample of ``sample`` strings of a kind at most."""
    return train(_sample(docs, sample))


def spans(text: str, model: Model) -> list[Span]:
    """(kind, start, end) by start, then kind: base matches and strings of a learned format."""
    base = base_spans(text)
    found = [s[:3] for s in base]
    edges = {p for s in base for p in s[1:3]}
    for candidate in candidates(text, base):
        for start, end, string in dict.fromkeys((candidate, bare(*candidate, edges))):
            if kind := model.kind(string):
                found.append((f"like_{kind}", start, end))
                break
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = "array<struct<kind: string, start: int, end: int>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find_secrets(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, spans) for each row: all base matches and strings of a learned format."""
    model = fit(docs, sample)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [
            [dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans(t or "", model)]
            for t in batch.column("text").to_pylist()
        ]
        return common.record_batch(doc_id=batch.column("doc_id"), spans=pa.array(found, _ARROW))

    return common.map_batches(common.documents(docs, "text"), run, f"doc_id long, spans {SPANS}")


def masked(text: str, found: list[Span], mask: str) -> str:
    out, at = [], 0
    for _, start, end in found:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, mask: str = "[SECRET]", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``mask``; other columns and nulls stay."""
    model = fit(docs, sample)
    place = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        clean = [
            t and masked(t, spans(t, model), mask) for t in batch.column("text").to_pylist()
        ]
        return batch.set_column(place, "text", pa.array(clean, pa.string()))

    return common.map_batches(docs, run, docs.schema)
