"""Search rules as one deterministic automaton over byte classes.

Each rule (a small regular-expression dialect) becomes a nondeterministic automaton; subset
construction over all rules at once gives one table of transitions, minimised by partition
refinement. Per rule the automaton follows the leftmost match, as far as it goes, and then starts
anew: candidate starts are kept as sets in order of age, and once the oldest accepts the younger ones
are dropped. The start of a match is found by running the rule's reversed automaton from its end.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

_ALL = frozenset(range(256))


class _Parser:
    """Literals, ``[classes]``, ``(groups|alternatives)``, ``? * + {m} {m,}`` and ``\\xHH`` or escaped signs."""

    def __init__(self, pattern: str):
        self.s, self.i = pattern, 0
        self.edges: list[list[tuple[frozenset | None, int]]] = []  # None: taken without a byte
        self.start, self.end = self.either()
        if self.i != len(pattern):
            raise ValueError(f"cannot read {pattern!r} from position {self.i}")

    def state(self) -> int:
        self.edges.append([])
        return len(self.edges) - 1

    def peek(self) -> str:
        return self.s[self.i : self.i + 1]

    def either(self) -> tuple[int, int]:
        start, end = self.state(), self.state()
        while True:
            a, b = self.sequence()
            self.edges[start].append((None, a))
            self.edges[b].append((None, end))
            if self.peek() != "|":
                return start, end
            self.i += 1

    def sequence(self) -> tuple[int, int]:
        start = end = self.state()
        while self.peek() not in ("", "|", ")"):
            at = self.i
            a, b = self.atom()
            after = self.i
            low, high = self.repeat()
            resume = self.i
            for k in range(max(low, 1 if high is None or high > low else low)):
                if k:
                    self.i = at
                    a, b = self.atom()
                self.edges[end].append((None, a))
                if k >= low:
                    self.edges[a].append((None, b)) if a != b else None
                end = b
            if high is None:
                self.edges[b].append((None, a))
            self.i = resume if resume > after else after
        return start, end

    def repeat(self) -> tuple[int, int | None]:
        c = self.peek()
        if c and c in "?*+":
            self.i += 1
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        if c == "{":
            stop = self.s.index("}", self.i)
            low, comma, high = self.s[self.i + 1 : stop].partition(",")
            self.i = stop + 1
            if comma and high or int(low) < 1:
                raise ValueError("only {m} and {m,} with m of 1 or more are known")
            return int(low), None if comma else int(low)
        return 1, 1

    def atom(self) -> tuple[int, int]:
        c = self.peek()
        if c == "(":
            self.i += 1
            a, b = self.either()
            if self.peek() != ")":
                raise ValueError(f"group not closed in {self.s!r}")
            self.i += 1
            return a, b
        a, b = self.state(), self.state()
        self.edges[a].append((self.charset() if c == "[" else frozenset((self.char(),)), b))
        return a, b

    def char(self) -> int:
        c = self.s[self.i]
        if c == "\\" and self.s[self.i + 1] == "x":
            self.i += 4
            return int(self.s[self.i - 2 : self.i], 16)
        self.i += 2 if c == "\\" else 1
        code = ord(self.s[self.i - 1])
        if code > 127:
            raise ValueError("rules are written in ASCII")
        return code

    def charset(self) -> frozenset:
        self.i += 1
        out: set[int] = set()
        while self.peek() != "]":
            low = high = self.char()
            if self.peek() == "-" and self.s[self.i + 1] != "]":
                self.i += 1
                high = self.char()
            out |= set(range(low, high + 1))
        self.i += 1
        return frozenset(out)


class _Nfa:
    def __init__(self, pattern: str):
        parsed = _Parser(pattern)
        self.edges, self.start, self.end = parsed.edges, parsed.start, parsed.end

    def reversed(self) -> _Nfa:
        out = object.__new__(_Nfa)
        out.edges = [[] for _ in self.edges]
        for a, edges in enumerate(self.edges):
            for on, b in edges:
                out.edges[b].append((on, a))
        out.start, out.end = self.end, self.start
        return out

    def closure(self, states) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for on, b in self.edges[todo.pop()]:
                if on is None and b not in seen:
                    seen.add(b)
                    todo.append(b)
        return frozenset(seen)

    def step(self, states: frozenset, byte: int) -> frozenset:
        return self.closure({b for a in states for on, b in self.edges[a] if on is not None and byte in on})

    def alphabet(self) -> set[frozenset]:
        return {on for edges in self.edges for on, _ in edges if on is not None}


def _classes(sets: set[frozenset]) -> tuple[bytes, list[int]]:
    """Bytes that no set tells apart get one class; a byte to stand for each class."""
    ordered = sorted(sets, key=sorted)
    numbers: dict[tuple, int] = {}
    table = bytes(numbers.setdefault(tuple(b in s for s in ordered), len(numbers)) for b in range(256))
    return table, [table.index(k) for k in range(len(numbers))]


class _Search:
    """One rule's search state: candidate sets, oldest first, and whether the oldest has matched."""

    def __init__(self, nfa: _Nfa, name: str):
        self.nfa, self.name, self.first = nfa, name, nfa.closure({nfa.start})
        if nfa.end in self.first:
            raise ValueError(f"rule {name!r} matches the empty text")

    def step(self, state: tuple[bool, tuple[frozenset, ...]], byte: int) -> tuple[bool, tuple[frozenset, ...]]:
        matched, groups = state
        if matched:
            grown = self.nfa.step(groups[0], byte)
            if grown:
                if self.nfa.end not in grown:
                    raise ValueError(f"rule {self.name!r}: a longer try may fail after a match")
                return True, (grown,)
            groups = ()
        out: list[frozenset] = []
        seen: set[int] = set()
        for group in (*groups, self.first):
            fresh = self.nfa.step(group, byte) - seen
            if not fresh:
                continue
            seen |= fresh
            out.append(fresh)
            if self.nfa.end in fresh:
                if len(out) > 1:
                    raise ValueError(f"rule {self.name!r}: a match may begin inside an open one")
                return True, (fresh,)
        return False, tuple(out)


class Automaton(NamedTuple):
    """Transitions by state and byte class, premultiplied: the next row is ``table[row + class]``.

    Rows from ``matching`` on have rules inside a match; ``masks`` tells which, by row.
    """

    names: list[str]
    classes: bytes
    table: list[int]
    start: int
    matching: int
    masks: dict[int, int]
    backward: list[tuple[bytes, list[list[int]], list[bool]]]

    @property
    def states(self) -> int:
        return len(self.table) // (max(self.classes) + 1)


def compile_rules(rules: dict[str, str]) -> Automaton:
    """One minimal automaton for all rules; raises where a rule needs more than one pass."""
    nfas = [_Nfa(p) for p in rules.values()]
    searches = [_Search(n, name) for n, name in zip(nfas, rules, strict=True)]
    classes, samples = _classes({s for n in nfas for s in n.alphabet()})
    start = tuple((False, ()) for _ in searches)
    numbers = {start: 0}
    moves: list[list[int]] = []
    todo = [start]
    for state in todo:  # grows while it is walked
        row = []
        for byte in samples:
            to = tuple(s.step(x, byte) for s, x in zip(searches, state, strict=True))
            if to not in numbers:
                numbers[to] = len(numbers)
                todo.append(to)
            row.append(numbers[to])
        moves.append(row)
    masks = [sum(1 << k for k, (matched, _) in enumerate(state) if matched) for state in todo]
    block = _refine(masks, moves)
    first: dict[int, int] = {}
    for state, b in enumerate(block):
        first.setdefault(b, state)
    order = sorted(first, key=lambda b: (masks[first[b]] != 0, b))  # matching states last
    place = {b: k * len(samples) for k, b in enumerate(order)}
    table = [place[block[to]] for b in order for to in moves[first[b]]]
    return Automaton(
        list(rules),
        classes,
        table,
        place[block[0]],
        min((place[b] for b in order if masks[first[b]]), default=len(table)),
        {place[b]: masks[first[b]] for b in order},
        [_backward(n.reversed()) for n in nfas],
    )


def _refine(masks: list[int], moves: list[list[int]]) -> list[int]:
    """Coarsest partition of the states that agrees with masks and moves."""
    block, count = masks, -1
    while True:
        numbers: dict[tuple, int] = {}
        block = [numbers.setdefault((b, *(block[to] for to in row)), len(numbers)) for b, row in zip(block, moves, strict=True)]
        if len(numbers) == count:
            return block
        count = len(numbers)


def _backward(nfa: _Nfa) -> tuple[bytes, list[list[int]], list[bool]]:
    """Deterministic form of a reversed rule; -1 where it is stuck."""
    classes, samples = _classes(nfa.alphabet())
    start = nfa.closure({nfa.start})
    numbers, todo, moves = {start: 0}, [start], []
    for state in todo:
        row = []
        for byte in samples:
            to = nfa.step(state, byte)
            if to and to not in numbers:
                numbers[to] = len(numbers)
                todo.append(to)
            row.append(numbers[to] if to else -1)
        moves.append(row)
    return classes, moves, [nfa.end in s for s in todo]


def scan(a: Automaton, data: bytes) -> Iterator[tuple[int, int, int]]:
    """(rule number, start, end) of every match, as byte offsets, in order of ends per rule."""
    table, row, matching, masks = a.table, a.start, a.matching, a.masks
    coded = data.translate(a.classes)
    last = [0] * len(a.names)
    open_mask = 0
    bytes_left = iter(coded)
    n = len(coded)
    for c in bytes_left:
        row = table[row + c]
        if row >= matching or open_mask:
            mask = masks[row]
            closed = open_mask & ~mask
            if closed:
                at = n - bytes_left.__length_hint__() - 1
                yield from _close(a, data, closed, at, last)
            open_mask = mask
    if open_mask:
        yield from _close(a, data, open_mask, n, last)


def _close(a: Automaton, data: bytes, mask: int, end: int, last: list[int]) -> Iterator[tuple[int, int, int]]:
    for k in range(len(a.names)):
        if mask >> k & 1:
            classes, moves, final = a.backward[k]
            state, start = 0, end
            for at in range(end - 1, last[k] - 1, -1):
                state = moves[state][classes[data[at]]]
                if state < 0:
                    break
                if final[state]:
                    start = at
            last[k] = end
            yield k, start, end
