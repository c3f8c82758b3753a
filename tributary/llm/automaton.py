"""Regular expressions over bytes as one deterministic automaton in transition arrays.

Supported: literals, `\\xHH` and escaped signs, classes with ranges and negation, groups,
alternation, `?`, `*`, `+`, `{m}` and `{m,}`. A pattern becomes position sets (Glushkov),
subset construction makes them states, and partition refinement merges equal states.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class _Node:
    """A part of a pattern: whether it matches nothing, first and last places, and who follows whom."""

    empty: bool
    first: frozenset
    last: frozenset


class _Pattern:
    def __init__(self, text: str, fold_case: bool, backward: bool):
        self.text, self.at, self.fold_case, self.backward = text, 0, fold_case, backward
        self.sets: list[frozenset] = []
        self.follow: list[set] = []
        self.root = self._alternatives()
        if self.at != len(text):
            raise ValueError(f"unexpected {text[self.at]!r} at {self.at} in {text!r}")

    def _peek(self) -> str:
        return self.text[self.at] if self.at < len(self.text) else ""

    def _alternatives(self) -> _Node:
        node = self._sequence()
        while self._peek() == "|":
            self.at += 1
            other = self._sequence()
            node = _Node(node.empty or other.empty, node.first | other.first, node.last | other.last)
        return node

    def _sequence(self) -> _Node:
        node = _Node(True, frozenset(), frozenset())
        while self._peek() not in ("", "|", ")"):
            node = self._join(node, self._repeated())
        return node

    def _join(self, a: _Node, b: _Node) -> _Node:
        if self.backward:
            a, b = b, a
        for x in a.last:
            self.follow[x] |= b.first
        return _Node(
            a.empty and b.empty, a.first | (b.first if a.empty else frozenset()), b.last | (a.last if b.empty else frozenset())
        )

    def _repeated(self) -> _Node:
        start = self.at
        node = self._atom()
        end = self.at
        sign = self._peek()
        if sign and sign in "?*+":
            self.at += 1
            return self._loop(node, sign)
        if sign == "{":
            close = self.text.index("}", self.at)
            least, _, more = self.text[self.at + 1 : close].partition(",")
            open_end = "," in self.text[self.at : close]
            if more:
                raise ValueError("an upper bound on repeats is not supported")
            for i in range(1, int(least)):  # each repeat gets places of its own
                self.at = start
                again = self._atom()
                if i == int(least) - 1 and open_end:
                    again = self._loop(again, "+")
                node = self._join(node, again)
            if int(least) == 1 and open_end:
                node = self._loop(node, "+")
            assert self.at == end or int(least) == 1
            self.at = close + 1
        return node

    def _loop(self, node: _Node, sign: str) -> _Node:
        if sign in "*+":
            for x in node.last:
                self.follow[x] |= node.first
        return _Node(node.empty or sign in "?*", node.first, node.last)

    def _atom(self) -> _Node:
        if self._peek() == "(":
            self.at += 1
            node = self._alternatives()
            if self._peek() != ")":
                raise ValueError(f"unclosed group in {self.text!r}")
            self.at += 1
            return node
        allowed = self._class() if self._peek() == "[" else frozenset([self._byte()])
        if self.fold_case:
            allowed = allowed | {b ^ 32 for b in allowed if chr(b).isascii() and chr(b).isalpha()}
        self.sets.append(allowed)
        self.follow.append(set())
        place = frozenset([len(self.sets) - 1])
        return _Node(False, place, place)

    def _byte(self) -> int:
        c = self._peek()
        self.at += 1
        if c != "\\":
            return ord(c)
        c = self._peek()
        self.at += 1
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return ord(c)

    def _class(self) -> frozenset:
        self.at += 1
        negated = self._peek() == "^"
        self.at += negated
        found: set[int] = set()
        while self._peek() != "]":
            low = self._byte()
            if self._peek() == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                found |= set(range(low, self._byte() + 1))
            else:
                found.add(low)
        self.at += 1
        return frozenset(set(range(256)) - found if negated else found)


@dataclass
class Automaton:
    """step[state * kinds + kind[byte]] is the next state times `kinds`; state 0 is the start.

    accepts[state] has bit r set if a match of pattern r ends there. States from `first_accepting`
    on accept something. `dead` is the state that nothing leaves, or -1.
    """

    kind: np.ndarray
    kinds: int
    step: np.ndarray
    accepts: np.ndarray
    first_accepting: int
    dead: int

    def longest(self, data: bytes, start: int) -> int:
        """End of the longest match that begins at `start`, -1 if none does."""
        step, kind, dead = self.lists()
        state, end = 0, -1
        for at in range(start, len(data)):
            state = step[state + kind[data[at]]]
            if state == dead:
                break
            if state >= self.first_accepting * self.kinds:
                end = at + 1
        return end

    def farthest_back(self, data: bytes, end: int, floor: int) -> int:
        """For an automaton of reversed patterns: the leftmost start >= floor of a match that ends at `end`."""
        step, kind, dead = self.lists()
        state, start = 0, -1
        for at in range(end - 1, floor - 1, -1):
            state = step[state + kind[data[at]]]
            if state == dead:
                break
            if state >= self.first_accepting * self.kinds:
                start = at
        return start

    def lists(self) -> tuple[list, list, int]:
        if not hasattr(self, "_cached"):
            self._cached = (self.step.tolist(), self.kind.tolist(), self.dead * self.kinds)
        return self._cached


def compile_patterns(patterns: list[tuple[str, bool]], *, anywhere: bool = False, backward: bool = False) -> Automaton:
    """One automaton for all patterns (text, whether letters match either case).

    With `anywhere` a match may begin at every byte, else only at the first. `backward` reads
    the patterns from their end.
    """
    parsed = [_Pattern(text, fold_case, backward) for text, fold_case in patterns]
    sets, follow, first, last = [], [], set(), {}
    for r, p in enumerate(parsed):
        base = len(sets)
        sets += p.sets
        follow += [{x + base for x in f} for f in p.follow]
        first |= {x + base for x in p.root.first}
        for x in p.root.last:
            last[x + base] = r
    # Bytes that every place treats alike are one kind.
    member = np.zeros((256, len(sets)), bool)
    for x, allowed in enumerate(sets):
        member[sorted(allowed), x] = True
    _, example, kind = np.unique(member, axis=0, return_index=True, return_inverse=True)
    kind, kinds = kind.ravel(), len(example)

    start = frozenset([-1])
    numbers, queue, rows, accepts = {start: 0}, [start], [], []
    for state in queue:
        ahead = set()
        for x in state:
            ahead |= first if x == -1 else follow[x]
        if anywhere:
            ahead |= first
        accepts.append(sum({1 << last[x] for x in state if x in last}))
        row = []
        for byte in example:
            target = frozenset(x for x in ahead if member[byte, x])
            if not target and anywhere:
                target = start
            if target not in numbers:
                numbers[target] = len(queue)
                queue.append(target)
            row.append(numbers[target])
        rows.append(row)
    table, accepts = np.array(rows), np.array(accepts, object)
    return _minimal(table, accepts, kind.astype(np.uint8), kinds)


def _minimal(table: np.ndarray, accepts: np.ndarray, kind: np.ndarray, kinds: int) -> Automaton:
    """Merge states that no text tells apart, and number accepting ones last."""
    _, group = np.unique(accepts.astype(str), return_inverse=True)
    while True:
        signature = np.concatenate([group[:, None], group[table]], axis=1)
        _, finer = np.unique(signature, axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == group.max():
            break
        group = finer
    n = int(group.max()) + 1
    example = np.zeros(n, np.int64)
    example[group[::-1]] = np.arange(len(group))[::-1]
    accepting = np.array([accepts[e] != 0 for e in example])
    order = sorted(range(n), key=lambda g: (g != group[0], bool(accepting[g]), example[g]))
    new = np.empty(n, np.int64)
    new[order] = np.arange(n)
    step = new[group[table[example[order]]]]
    marks = np.array([int(accepts[example[g]]) for g in order], np.int64)
    alone = [s for s in range(n) if (step[s] == s).all() and marks[s] == 0]
    quiet = int((marks == 0).sum())
    return Automaton(kind, kinds, (step * kinds).ravel().astype(np.int32), marks, quiet, alone[0] if alone and alone[0] != 0 else -1)
