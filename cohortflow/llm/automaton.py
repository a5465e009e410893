"""Regular expressions to deterministic automata: subset construction, minimisation, transition
arrays over byte classes, and a vectorised pass that runs one automaton over a block of bytes.

The expressions are those that ``re`` can parse as bytes, without look-around, back references and
anchors; repeats are unrolled.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from re import _constants as C
from re import _parser

import numpy as np


class Nfa:
    """Thompson's construction; a state has byte edges and empty edges."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def add(self, pattern: bytes, begin: int) -> int:
        """The end state of the pattern, read from ``begin``."""
        return self._seq(_parser.parse(pattern), begin)

    def _seq(self, items, at: int) -> int:
        for op, arg in items:
            at = self._one(op, arg, at)
        return at

    def _bytes(self, chars: frozenset[int], at: int) -> int:
        end = self.state()
        self.edges[at].append((chars, end))
        return end

    def _one(self, op, arg, at: int) -> int:
        if op is C.LITERAL:
            return self._bytes(frozenset([arg]), at)
        if op is C.ANY:
            return self._bytes(frozenset(range(256)) - {10}, at)
        if op is C.IN:
            chars: set[int] = set()
            for kind, x in arg:
                if kind is C.LITERAL:
                    chars.add(x)
                elif kind is C.RANGE:
                    chars.update(range(x[0], x[1] + 1))
                elif kind is not C.NEGATE:
                    raise ValueError(f"{kind} isn't supported")
            return self._bytes(frozenset(range(256)) - chars if arg[0][0] is C.NEGATE else frozenset(chars), at)
        if op is C.SUBPATTERN:
            return self._seq(arg[3], at)
        if op is C.BRANCH:
            end = self.state()
            for branch in arg[1]:
                begin = self.state()
                self.empty[at].append(begin)
                self.empty[self._seq(branch, begin)].append(end)
            return end
        if op is C.MAX_REPEAT:
            low, high, body = arg
            for _ in range(low):
                at = self._seq(body, at)
            if high is C.MAXREPEAT:
                loop, end = self.state(), self.state()
                self.empty[at] += [loop, end]
                self.empty[self._seq(body, loop)] += [loop, end]
                return end
            end = self.state()
            self.empty[at].append(end)
            for _ in range(high - low):
                begin = self.state()
                self.empty[at].append(begin)
                at = self._seq(body, begin)
                self.empty[at].append(end)
            return end
        raise ValueError(f"{op} isn't supported")


@dataclass
class Dfa:
    """``next[state * classes + class_of[byte]]``; states from ``accepting`` on accept, and ``rules[state]``
    are the bits of the rules that do. State ``begin`` is the first one; ``dead`` has no way out (-1: none)."""

    class_of: np.ndarray
    classes: int
    next: np.ndarray
    begin: int
    accepting: int
    rules: np.ndarray
    dead: int


def compile_rules(patterns: list[bytes], anywhere: bool) -> Dfa:
    """One minimal automaton for all patterns. ``anywhere``: a match may begin at any byte."""
    nfa = Nfa()
    root = nfa.state()
    ends: dict[int, int] = defaultdict(int)
    for k, p in enumerate(patterns):
        begin = nfa.state()
        nfa.empty[root].append(begin)
        ends[nfa.add(p, begin)] |= 1 << k

    # bytes that no edge tells apart form a class
    of: dict[int, list[int]] = defaultdict(list)
    sets = list({chars for edges in nfa.edges for chars, _ in edges})
    for byte in range(256):
        of[sum(1 << i for i, s in enumerate(sets) if byte in s)].append(byte)
    class_of = np.zeros(256, np.int64)
    for k, members in enumerate(of.values()):
        class_of[members] = k
    first = [members[0] for members in of.values()]

    def closure(states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for x in nfa.empty[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)

    start = closure([root])
    number, todo, table = {start: 0}, [start], []
    while todo:  # subset construction
        state = todo.pop(0)
        row = []
        for byte in first:
            to = {end for s in state for chars, end in nfa.edges[s] if byte in chars}
            to = closure(to) | start if anywhere else closure(to)
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append(number[to])
        table.append(row)
    rules = [0] * len(number)
    for state, k in number.items():
        for s in state:
            rules[k] |= ends.get(s, 0)

    block = {r: i for i, r in enumerate(sorted(set(rules)))}
    part = [block[r] for r in rules]
    while True:  # Moore's refinement: states that go on alike, by class, are one
        seen: dict[tuple, int] = {}
        new = [seen.setdefault((part[s], *(part[t] for t in table[s])), len(seen)) for s in range(len(table))]
        if len(seen) == len(set(part)):
            break
        part = new
    part = new
    n = max(part) + 1
    member = [part.index(k) for k in range(n)]
    order = sorted(range(n), key=lambda k: (rules[member[k]] != 0, k))
    place = {k: i for i, k in enumerate(order)}
    go = np.array([[place[part[t]] for t in table[member[k]]] for k in order], np.int64)
    own_rules = np.array([rules[member[k]] for k in order], np.int64)
    accepting = int((own_rules == 0).sum())
    dead = next((i for i in range(accepting) if (go[i] == i).all() and i != place[part[0]]), -1)
    return Dfa(class_of, len(first), go.ravel(), place[part[0]], accepting, own_rules, dead)


def accepted_at(dfa: Dfa, data: np.ndarray, lane: int = 1024) -> np.ndarray:
    """The positions after which the automaton accepts, in one pass over ``data``.

    The bytes are laid out as lanes that all step at once. Each lane first runs as if the automaton
    began there; wherever the lane before really ended in another state, the lane runs again from
    that state, until nothing changes, so the result is that of a single run."""
    if not len(data):
        return np.zeros(0, np.int64)
    lanes = -(-len(data) // lane)
    grid = np.zeros(lanes * lane, np.uint8)
    grid[: len(data)] = data
    steps = np.ascontiguousarray(dfa.class_of.astype(np.int32)[grid].reshape(lanes, lane).T)
    go = (dfa.next * dfa.classes).astype(np.int32)  # states as offsets into the array
    begin, accepting = dfa.begin * dfa.classes, dfa.accepting * dfa.classes

    def ends(rows: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        most = np.zeros(len(states), np.int32)
        own = steps if len(rows) == lanes else steps[:, rows]
        for k in range(lane):
            states = go[states + own[k]]
            np.maximum(most, states, out=most)
        return states, most

    everyone = np.arange(lanes)
    entry = np.full(lanes, begin, np.int32)
    exit_, most = ends(everyone, entry)
    while True:
        actual = np.concatenate([[np.int32(begin)], exit_[:-1]])
        again = np.flatnonzero(actual != entry)
        if not len(again):
            break
        entry[again] = actual[again]
        exit_[again], most[again] = ends(again, actual[again])
    hit = np.flatnonzero(most >= accepting)
    found = []
    if len(hit):
        own, states = steps[:, hit], entry[hit]
        for k in range(lane):
            states = go[states + own[k]]
            yes = np.flatnonzero(states >= accepting)
            if len(yes):
                found.append(hit[yes] * lane + k)
    at = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return at[at < len(data)]


def longest_from(dfa: Dfa, table: list[int], class_of: list[int], data: bytes, at: int) -> int:
    """The end of the longest match that begins at ``at`` (-1: none), by an anchored automaton."""
    state, end, n = dfa.begin, -1, dfa.classes
    for k in range(at, len(data)):
        state = table[state * n + class_of[data[k]]]
        if state == dfa.dead:
            break
        if state >= dfa.accepting:
            end = k + 1
    return end
