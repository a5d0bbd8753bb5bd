"""Regular expressions over bytes as deterministic automata: parsed, determinised, minimised.

Known: literals, ``\\xHH`` and escaped characters, classes, groups, ``(?i:...)`` for ASCII letters in either
case, ``|``, ``?``, ``*``, ``+`` and ``{m}``, ``{m,}``, ``{m,n}``. No anchors, captures or lazy repeats.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# A parsed expression: ("bytes", frozenset) | ("all", [parts]) | ("any", [choices]) | ("repeat", part, least, most or None)
Node = tuple


class _Parser:
    def __init__(self, pattern: str):
        self.pattern, self.at, self.fold = pattern, 0, False

    def _peek(self) -> str:
        return self.pattern[self.at : self.at + 1]

    def _take(self) -> str:
        if self.at >= len(self.pattern):
            raise ValueError(f"{self.pattern} ends too early")
        self.at += 1
        return self.pattern[self.at - 1]

    def choices(self) -> Node:
        found = [self.sequence()]
        while self._peek() == "|":
            self.at += 1
            found.append(self.sequence())
        return found[0] if len(found) == 1 else ("any", found)

    def sequence(self) -> Node:
        parts = []
        while self._peek() not in ("", "|", ")"):
            parts.append(self.repeated(self.atom()))
        return ("all", parts)

    def repeated(self, part: Node) -> Node:
        while (mark := self._peek()) and mark in "?*+{":
            self.at += 1
            if mark == "{":
                end = self.pattern.index("}", self.at)
                least, comma, most = self.pattern[self.at : end].partition(",")
                self.at = end + 1
                part = ("repeat", part, int(least), int(most) if most else None if comma else int(least))
            else:
                part = ("repeat", part, int(mark == "+"), 1 if mark == "?" else None)
        return part

    def atom(self) -> Node:
        mark = self._take()
        if mark == "(":
            outer = self.fold
            if self.pattern.startswith("?i:", self.at):
                self.at, self.fold = self.at + 3, True
            elif self.pattern.startswith("?:", self.at):
                self.at += 2
            inner = self.choices()
            if self._take() != ")":
                raise ValueError(f"an open group in {self.pattern}")
            self.fold = outer
            return inner
        if mark == "[":
            return ("bytes", self.one_of())
        return ("bytes", self.cased({self.escaped() if mark == "\\" else ord(mark)}))

    def escaped(self) -> int:
        mark = self._take()
        if mark == "x":
            self.at += 2
            return int(self.pattern[self.at - 2 : self.at], 16)
        return ord(mark)

    def one_of(self) -> frozenset[int]:
        inverse = self._peek() == "^"
        self.at += inverse
        found: set[int] = set()
        while (mark := self._take()) != "]":
            low = self.escaped() if mark == "\\" else ord(mark)
            if self._peek() == "-" and self.pattern[self.at + 1] != "]":
                self.at += 1
                mark = self._take()
                found.update(range(low, (self.escaped() if mark == "\\" else ord(mark)) + 1))
            else:
                found.add(low)
        return frozenset(range(256)) - self.cased(found) if inverse else self.cased(found)

    def cased(self, found: set[int]) -> frozenset[int]:
        both = {ord(c.swapcase()) for c in map(chr, found) if c.isascii() and c.isalpha()} if self.fold else set()
        if max(found, default=0) > 255:
            raise ValueError("only bytes are matched")
        return frozenset(found | both)


def parsed(pattern: str) -> Node:
    parser = _Parser(pattern)
    node = parser.choices()
    if parser.at < len(pattern):
        raise ValueError(f"cannot read {pattern} from {parser.at}")
    return node


def backwards(node: Node) -> Node:
    """The expression of the reversed strings."""
    if node[0] == "all":
        return ("all", [backwards(x) for x in reversed(node[1])])
    if node[0] == "any":
        return ("any", [backwards(x) for x in node[1]])
    return ("repeat", backwards(node[1]), *node[2:]) if node[0] == "repeat" else node


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []  # moves that read nothing
        self.moves: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append(None)
        return len(self.free) - 1

    def add(self, node: Node, start: int) -> int:
        """Builds the expression from a state on; gives its end state."""
        if node[0] == "bytes":
            end = self.state()
            inner = self.state()
            self.free[start].append(inner)
            self.moves[inner] = (node[1], end)
            return end
        if node[0] == "all":
            for part in node[1]:
                start = self.add(part, start)
            return start
        if node[0] == "any":
            end = self.state()
            for choice in node[1]:
                begin = self.state()
                self.free[start].append(begin)
                self.free[self.add(choice, begin)].append(end)
            return end
        _, part, least, most = node
        for _ in range(least):
            start = self.add(part, start)
        end = self.state()
        if most is None:
            loop = self.state()
            self.free[start].append(loop)
            self.free[self.add(part, loop)].append(loop)
            self.free[loop].append(end)
            return end
        for _ in range(most - least):
            self.free[start].append(end)
            begin = self.state()
            self.free[start].append(begin)
            start = self.add(part, begin)
        self.free[start].append(end)
        return end

    def reached(self, states: frozenset[int]) -> frozenset[int]:
        found, stack = set(states), list(states)
        while stack:
            for s in self.free[stack.pop()]:
                if s not in found:
                    found.add(s)
                    stack.append(s)
        return frozenset(found)


@dataclass(frozen=True)
class Automaton:
    """``moves[state, byte]`` is the next state, ``accepts[state]`` a bit for each expression that ends there.

    States are ordered: those that accept nothing come first, then those from ``accepting`` on. State
    ``dead`` (-1: none) can reach no acceptance.
    """

    moves: np.ndarray
    accepts: np.ndarray
    start: int
    accepting: int
    dead: int

    def longest(self, data: bytes, at: int) -> int:
        """The end of the longest match that begins here, -1 if none does."""
        state, best = self.start, at if self.accepts[self.start] else -1
        for i in range(at, len(data)):
            state = self.moves[state, data[i]]
            if state == self.dead:
                break
            if state >= self.accepting:
                best = i + 1
        return best

    def longest_back(self, data: bytes, end: int, least: int) -> int:
        """For a reversed expression: the leftmost begin, not below ``least``, of a match that ends here, or -1."""
        state, best = self.start, -1
        for i in range(end - 1, least - 1, -1):
            state = self.moves[state, data[i]]
            if state == self.dead:
                break
            if state >= self.accepting:
                best = i
        return best


def compiled(expressions: list[Node], anywhere: bool = False) -> Automaton:
    """One automaton for all expressions; ``anywhere``: they may begin at every byte."""
    nfa = _Nfa()
    start = nfa.state()
    ends = {}
    for bit, node in enumerate(expressions):
        begin = nfa.state()
        nfa.free[start].append(begin)
        ends[nfa.add(node, begin)] = 1 << bit
    # bytes that every move treats alike are one symbol
    marks = np.zeros((len(nfa.moves), 256), bool)
    for i, move in enumerate(nfa.moves):
        if move:
            marks[i, list(move[0])] = True
    _, samples, symbol = np.unique(marks, axis=1, return_index=True, return_inverse=True)
    samples = [int(b) for b in samples]
    first = nfa.reached(frozenset([start]))
    known, order, rows = {first: 0}, [first], []
    for states in order:
        row = []
        for byte in samples:
            after = {nfa.moves[s][1] for s in states if nfa.moves[s] and byte in nfa.moves[s][0]}
            target = nfa.reached(frozenset(after | {start} if anywhere else after))
            if target not in known:
                known[target] = len(order)
                order.append(target)
            row.append(known[target])
        rows.append(row)
    moves = np.array(rows, np.int64)
    accepts = np.array([sum(ends.get(s, 0) for s in states) for states in order], np.int64)
    # states are one while they accept alike and move to states that are one
    _, part = np.unique(accepts, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack((part, part[moves])), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == part.max():
            break
        part = finer
    groups = int(part.max()) + 1
    sample = np.zeros(groups, np.int64)
    sample[part] = np.arange(len(part))
    rank = np.argsort(accepts[sample] > 0, kind="stable")  # silent states first
    place = np.empty(groups, np.int64)
    place[rank] = np.arange(groups)
    small = place[part[moves[sample[rank]]]]
    accepts = accepts[sample[rank]]
    silent = int((accepts == 0).sum())
    stuck = [s for s in range(silent) if (small[s] == s).all()]
    return Automaton(small[:, np.asarray(symbol).ravel()].astype(np.int32), accepts, int(place[part[0]]), silent, stuck[0] if stuck else -1)
