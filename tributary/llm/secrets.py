"""Secret scans by one combined automaton over the bytes of whole texts.

All rules are compiled into a single minimal automaton whose arrays are walked once per byte;
it tells which rules have a match ending where. Texts are cut after bytes that lead back to
the start from every state (such as a newline), and the parts of a batch are walked side
by side, a byte of each at a time. Only where a rule fires, its reversed automaton finds the
leftmost start and its own automaton the longest end, so that matches of a rule are
leftmost, longest and do not overlap.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tributary.llm.automaton import Automaton, compile_patterns
from tributary.llm.common import pieces
from tributary.llm.tokens import buffers


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts if it has `least` bytes after the longest match of `before` in it.

    Matches that do not count still use up their text.
    """

    name: str
    pattern: str
    least: int = 0
    before: str = ""
    fold_case: bool = False


NAME = "(password|passwd|secret|token|api_?key)"
SETS = "[\"']?\\x20*[:=]\\x20*[\"']?"
BASE_RULES = (
    Rule("assign", NAME + SETS + "[A-Za-z0-9+/_.=-]+", 12, NAME + SETS, True),
    Rule("access", "AKIA[A-Z0-9]+", 18),
    Rule("hex", "[0-9a-f]{16,}"),  # shorter runs cannot count, and no run begins inside one
)
MORE_RULES = (
    Rule("forge", "gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("maps", "AIza[A-Za-z0-9_-]+", 39),
    Rule("payment", "[sr]k_(live|test)_[A-Za-z0-9]+", 24),
    Rule("signed", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 40),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("login", "://[A-Za-z0-9._-]+:[A-Za-z0-9._!$&*+=-]+@", 8),
)
CUT_AFTER = 2048
STEPS = 256
FEW = 48


def _shortest(pattern: str) -> str:
    """The pattern without the open end of its last repeat."""
    if pattern.endswith(",}"):
        return pattern[:-2] + "}"
    return pattern[:-1] if pattern.endswith("]+") else pattern


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        patterns = [(r.pattern, r.fold_case) for r in rules]
        # The first place where a match can end is all the walk needs to tell; what a pattern
        # repeats at its end would only multiply the states.
        self.all = compile_patterns([(_shortest(p), f) for p, f in patterns], anywhere=True)
        self.forward = [compile_patterns([p]) for p in patterns]
        self.backward = [compile_patterns([p], backward=True) for p in patterns]
        self.before: list[Automaton | None] = [compile_patterns([(r.before, r.fold_case)]) if r.before else None for r in rules]
        table = self.all.step.reshape(-1, self.all.kinds)
        self.resets = (table == 0).all(axis=0)[self.all.kind]

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of the parts: of every text, and after a reset byte once a part is long."""
        begins, cuts = [offsets[:-1][np.diff(offsets) > 0]], np.flatnonzero(self.resets[data]) + 1
        for i in np.flatnonzero(np.diff(offsets) > 2 * CUT_AFTER):
            s, e = np.searchsorted(cuts, [offsets[i], offsets[i + 1] - CUT_AFTER])
            at, own = int(offsets[i]), cuts[s:e]
            while (k := int(np.searchsorted(own, at + CUT_AFTER))) < len(own):
                at = int(own[k])
                begins.append(np.array([at]))
        return np.sort(np.concatenate(begins))

    def events(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end, rule mask) of every place where a match ends, by place."""
        begins = self._cuts(data, offsets)
        if len(begins) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lengths = np.diff(np.append(begins, offsets[-1]))
        order = np.argsort(-lengths, kind="stable")
        begins, lengths = begins[order], lengths[order]
        kinds, step = self.all.kind[data], self.all.step
        accepting = self.all.first_accepting * self.all.kinds
        state, ends, marks = np.zeros(len(begins), np.int32), [], []
        shortest_first = lengths[::-1]
        for at in range(0, int(lengths[0]), STEPS):
            alive = len(lengths) - int(np.searchsorted(shortest_first, at, "right"))
            if alive < FEW:  # a few long parts are walked one after the other
                break
            reach = begins[None, :alive] + np.arange(at, min(at + STEPS, int(lengths[0])))[:, None]
            block = kinds[np.minimum(reach, len(kinds) - 1)]
            for j in range(len(block)):
                alive = len(lengths) - int(np.searchsorted(shortest_first, at + j, "right"))
                now = step[state[:alive] + block[j, :alive]]
                state[:alive] = now
                if now.max() >= accepting:
                    hit = np.flatnonzero(now >= accepting)
                    ends.append(begins[hit] + at + j + 1)
                    marks.append(self.all.accepts[now[hit] // self.all.kinds])
        else:
            at, alive = int(lengths[0]), 0
        for i in range(alive):
            end, mark = self._walk(kinds[begins[i] + at : begins[i] + lengths[i]].tobytes(), int(state[i]))
            ends.append(end + begins[i] + at)
            marks.append(mark)
        if not ends:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends, marks = np.concatenate(ends), np.concatenate(marks)
        order = np.argsort(ends, kind="stable")
        return ends[order], marks[order]

    def _walk(self, kinds: bytes, state: int) -> tuple[np.ndarray, np.ndarray]:
        step = self.all.lists()[0]
        accepting, ends, marks = self.all.first_accepting * self.all.kinds, [], []
        for at, kind in enumerate(kinds, 1):
            state = step[state + kind]
            if state >= accepting:
                ends.append(at)
                marks.append(self.all.accepts[state // self.all.kinds])
        return np.array(ends, np.int64), np.array(marks, np.int64)

    def matches(self, data: bytes, ends: list[int], marks: list[int]) -> list[tuple[int, int, int]]:
        """(start, rule, end) of the counting matches of one text, given its events."""
        found = []
        for r, rule in enumerate(self.rules):
            floor = 0
            for end, mark in zip(ends, marks, strict=True):
                if end <= floor or not mark >> r & 1:
                    continue
                start = self.backward[r].farthest_back(data, end, floor)
                if start < 0:
                    continue
                floor = self.forward[r].longest(data, start)
                value = self.before[r].longest(data, start) if self.before[r] else start
                if floor - value >= rule.least:
                    found.append((start, r, floor))
        return sorted(found)


def scan(documents: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """(doc_id, secrets) for every row: an array of (kind, start, end) by start, then rule order.

    Positions are code points, the end exclusive. Null and empty texts have none. Repeated
    rows are scanned alike, null ids are carried, and other columns are ignored.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    shared = documents.sparkSession.sparkContext.broadcast(Scanner(rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = shared.value
        of = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in pieces(batches):
            data, offsets = buffers(batch.column("text"))
            found: list[list] = [[] for _ in range(batch.num_rows)]
            ends, marks = scanner.events(data, offsets)
            cuts = np.searchsorted(ends, offsets, "right")
            for i in np.flatnonzero(cuts[1:] > cuts[:-1]):
                s, e = cuts[i], cuts[i + 1]
                text = data[offsets[i] : offsets[i + 1]]
                hits = scanner.matches(text.tobytes(), (ends[s:e] - offsets[i]).tolist(), marks[s:e].tolist())
                points = np.concatenate(([0], np.cumsum((text & 0xC0) != 0x80)))
                found[i] = [{"kind": rules[r].name, "start": int(points[a]), "end": int(points[b])} for a, r, b in hits]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, of)], names=["doc_id", "secrets"])

    schema = f"doc_id {kind}, secrets array<struct<kind: string, start: long, end: long>>"
    return documents.select("doc_id", "text").mapInArrow(run, schema)

