"""Probabilistic automata inferred from example strings by merging states (ALERGIA).

The merge test says nothing about states that few strings pass, and random strings leave the first
states of their prefix tree at once: left to the test alone they would all become one state, which
knows how often a symbol occurs and has forgotten prefix and length. So such states are told apart by
what is known of them, the last well-visited state on their way and their depth, and states
merge only with evidence on both sides. Where a loop is right, as in runs of any length, the pooled
states of successive depths pass the test and merge.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

ALPHABET = 66
#: Strings that must have passed a state before it is compared, or before "never" means anything.
EVIDENCE = 24
#: Symbols that came less often at a state tell that others may come there.
RARE = 3


@dataclass
class _State:
    """Strings that came here, that ended here, whose known head ends here, and where they went."""

    came: int = 0
    ended: int = 0
    open: int = 0
    next: dict[str, int] = field(default_factory=dict)
    took: dict[str, int] = field(default_factory=dict)


def _pooled_tree(strings: list[str], longest: int | None) -> list[_State]:
    """The prefix tree, in which states of few passes are one for each visited state and depth."""
    passes: dict[str, int] = {}
    for string in strings:
        for n in range(len(string) + 1):
            prefix = string[:n]
            passes[prefix] = passes.get(prefix, 0) + 1
            if passes[prefix] == 1 and n and passes[string[: n - 1]] == 1:
                # The first of its way: deeper prefixes are new as well until another one comes.
                break
    visited = {p for p, n in passes.items() if n >= EVIDENCE or not p}
    states, number = [_State()], {("", 0): 0}
    for string in strings:
        at, anchor = 0, ""
        states[0].came += 1
        for depth, symbol in enumerate(string, 1):
            if len(anchor) == depth - 1 and string[:depth] in visited:
                anchor = string[:depth]
            name = (anchor, depth)
            if name not in number:
                number[name] = len(states)
                states.append(_State())
            state = states[at]
            state.took[symbol] = state.took.get(symbol, 0) + 1
            # Successors share a state unless they are visited themselves: one a symbol all the same.
            state.next[symbol] = at = number[name]
            states[at].came += 1
        whole = longest is None or len(string) < longest
        states[at].ended += whole
        states[at].open += not whole
    return states


def _differ(f1: int, n1: int, f2: int, n2: int, bound: float) -> bool:
    """Hoeffding's test on two frequencies."""
    return abs(f1 / n1 - f2 / n2) > bound * (n1**-0.5 + n2**-0.5)


class Automaton:
    """States merged while their endings and transitions, followed to the end, are compatible.

    ``alpha`` is the test's error level; states are compared only with states already fixed, in the
    order of their depth, so the result depends on the strings alone. Strings of ``longest`` characters
    are heads of longer ones and do not end.
    """

    def __init__(self, strings: list[str], alpha: float = 0.05, longest: int | None = None):
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._states = states = _pooled_tree(strings, longest)
        self._into = list(range(len(states)))
        fixed, known, waiting = [0], {0}, [0]
        while waiting:
            parent = waiting.pop(0)
            for symbol in sorted(states[parent].next):
                new = self._find(states[parent].next[symbol])
                if new in known:
                    continue
                same = next((old for old in fixed if self._mergeable(old, new)), None)
                if same is None:
                    fixed.append(new)
                    known.add(new)
                    waiting.append(new)
                else:
                    self._merge(same, new)
                    # Folding may have given fixed states new successors.
                    fixed = list(dict.fromkeys(map(self._find, fixed)))
                    known, waiting = set(fixed), list(fixed)
                    break
        number = {f: i for i, f in enumerate(fixed)}
        #: For each state: symbol -> (log probability, state), log of the ending, log of the unseen,
        #: where an unseen symbol leads (where most go), mean surprise of a step, whether strings are
        #: known never to end there, and whether no other symbol is to be expected: all that came are common.
        self.moves, self.ends, self.unseen, self.other, self.usual = [], [], [], [], []
        self.never, self.closed = [], []
        for f in fixed:
            state = states[f]
            total = state.came + 0.5 * (ALPHABET + 1)
            steps = {s: (math.log((n + 0.5) / total), number[self._find(state.next[s])]) for s, n in state.took.items()}
            self.moves.append(steps)
            self.ends.append(math.log((state.ended + 0.5) / total))
            self.unseen.append(math.log(0.5 / total))
            goes: dict[int, int] = {number[f]: 0}
            for symbol, n in state.took.items():
                goes[steps[symbol][1]] = goes.get(steps[symbol][1], 0) + n
            self.other.append(max(goes, key=lambda to: (goes[to], -to)))
            counts = [*state.took.values(), state.ended]
            came = max(sum(counts), 1)
            logs = [*(p for p, _ in steps.values()), self.ends[-1]]
            self.usual.append(-sum(n / came * p for n, p in zip(counts, logs, strict=True)))
            self.closed.append(state.came >= EVIDENCE and not state.open and min(state.took.values(), default=RARE) >= RARE)
            self.never.append(state.came >= EVIDENCE and not state.ended and not state.open)
        del self._states, self._into

    def _find(self, state: int) -> int:
        while self._into[state] != state:
            self._into[state] = state = self._into[self._into[state]]
        return state

    def _mergeable(self, a: int, b: int) -> bool:
        """Evidence on both sides, and none against it here or further on."""
        if min(self._states[a].came, self._states[b].came) < EVIDENCE:
            return False
        stack, seen = [(a, b)], {(a, b)}
        while stack:
            a, b = stack.pop()
            one, two = self._states[a], self._states[b]
            if _differ(one.ended, one.came, two.ended, two.came, self._bound):
                return False
            for symbol in one.took.keys() | two.took.keys():
                if _differ(
                    one.took.get(symbol, 0), one.came, two.took.get(symbol, 0), two.came, self._bound
                ):
                    return False
                if symbol in one.next and symbol in two.next:
                    pair = self._find(one.next[symbol]), self._find(two.next[symbol])
                    if pair[0] != pair[1] and pair not in seen:
                        seen.add(pair)
                        stack.append(pair)
        return True

    def _merge(self, into: int, other: int) -> None:
        """Both become one state, and so do the states that one symbol then leads to."""
        stack = [(into, other)]
        while stack:
            a, b = map(self._find, stack.pop())
            if a == b:
                continue
            self._into[b] = a
            one, two = self._states[a], self._states[b]
            one.came += two.came
            one.ended += two.ended
            one.open += two.open
            for symbol, n in two.took.items():
                one.took[symbol] = one.took.get(symbol, 0) + n
                if symbol in one.next:
                    stack.append((one.next[symbol], two.next[symbol]))
                else:
                    one.next[symbol] = two.next[symbol]

    def judge(self, string: str) -> tuple[float, float, bool]:
        """Log likelihood of the whole string, its surprise, and whether it goes on and ends as strings may.

        The surprise is what the string is less likely than an average one on the same way.
        """
        at, total, usual, fits = 0, 0.0, 0.0, True
        for symbol in string:
            usual += self.usual[at]
            step = self.moves[at].get(symbol)
            if step is None:
                fits = fits and not self.closed[at]
                total, at = total + self.unseen[at], self.other[at]
            else:
                total, at = total + step[0], step[1]
        total += self.ends[at]
        usual += self.usual[at]
        return total, -total - usual, fits and not self.never[at]

    def score(self, string: str) -> float:
        """Log likelihood of the whole string, its end included."""
        return self.judge(string)[0]
