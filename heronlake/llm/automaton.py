"""Regular expressions over bytes as minimal deterministic automata in transition arrays.

A pattern is parsed into sets of bytes with sequence, choice and repetition, turned into its position automaton (one state
per byte of the written-out pattern, no empty moves), and made deterministic by subset construction; states that no
continuation tells apart are merged by partition refinement. Several patterns share one automaton, whose states carry a bit
per pattern. Bytes that all patterns treat alike share a column of the table.

Patterns know literals, `.`-free classes `[a-f0-9]`, groups, `|`, `?`, `*`, `+`, `{n}`, `{n,}`, `{n,m}`, `\\` before a literal
and `\\xHH`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


class _Parser:
    def __init__(self, pattern: str, ignore_case: bool) -> None:
        self.pattern, self.at, self.ignore_case = pattern, 0, ignore_case

    def peek(self) -> str:
        return self.pattern[self.at] if self.at < len(self.pattern) else ""

    def take(self) -> str:
        c = self.peek()
        if not c:
            raise ValueError(f"pattern ends too early: {self.pattern!r}")
        self.at += 1
        return c

    def byte(self) -> int:
        c = self.take()
        if c == "\\":
            c = self.take()
            if c == "x":
                return int(self.take() + self.take(), 16)
        if ord(c) > 127:
            raise ValueError(f"not ASCII: {c!r}")
        return ord(c)

    def members(self, found: set[int]) -> tuple:
        if self.ignore_case:
            found = found | {ord(chr(b).swapcase()) for b in found if b < 128 and chr(b).isalpha()}
        return ("set", frozenset(found))

    def choice(self) -> tuple:
        parts = [self.sequence()]
        while self.peek() == "|":
            self.at += 1
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("or", parts)

    def sequence(self) -> tuple:
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated(self.atom()))
        return ("then", parts)

    def atom(self) -> tuple:
        c = self.peek()
        if c == "(":
            self.at += 1
            inner = self.choice()
            if self.take() != ")":
                raise ValueError(f"group is not closed: {self.pattern!r}")
            return inner
        if c == "[":
            self.at += 1
            found: set[int] = set()
            while self.peek() != "]":
                low = self.byte()
                if self.peek() == "-" and self.pattern[self.at + 1:self.at + 2] != "]":
                    self.at += 1
                    found.update(range(low, self.byte() + 1))
                else:
                    found.add(low)
            self.at += 1
            return self.members(found)
        if c in ".^$*+?{":
            raise ValueError(f"not supported here: {c!r} in {self.pattern!r}")
        return self.members({self.byte()})

    def repeated(self, node: tuple) -> tuple:
        while self.peek() and self.peek() in "?*+{":
            c = self.take()
            if c == "{":
                text = ""
                while (d := self.take()) != "}":
                    text += d
                low, _, high = text.partition(",")
                most = int(low) if "," not in text else int(high) if high else None
                node = ("times", node, int(low), most)
            else:
                node = ("times", node, int(c == "+"), 1 if c == "?" else None)
        return node


def parse(pattern: str, ignore_case: bool = False) -> tuple:
    parser = _Parser(pattern, ignore_case)
    tree = parser.choice()
    if parser.peek():
        raise ValueError(f"closing bracket without an opening one: {pattern!r}")
    return tree


class Positions:
    """The position automaton of one pattern: byte sets, which positions may come first and last, and which follow which."""

    def __init__(self, tree: tuple) -> None:
        self.sets: list[frozenset[int]] = []
        self.follow: list[set[int]] = []
        self.nullable, self.first, self.last = self._add(tree)

    def _link(self, last: set[int], first: set[int]) -> None:
        for p in last:
            self.follow[p] |= first

    def _cat(self, parts) -> tuple[bool, set[int], set[int]]:
        empty, first, last = True, set(), set()
        for e, f, end in parts:
            self._link(last, f)
            first = first | f if empty else first
            last = last | end if e else end
            empty = empty and e
        return empty, first, last

    def _add(self, node: tuple) -> tuple[bool, set[int], set[int]]:
        kind = node[0]
        if kind == "set":
            self.sets.append(node[1])
            self.follow.append(set())
            here = {len(self.sets) - 1}
            return False, here, here
        if kind == "or":
            made = [self._add(n) for n in node[1]]
            return any(m[0] for m in made), set().union(*[m[1] for m in made]), set().union(*[m[2] for m in made])
        if kind == "then":
            return self._cat(self._add(n) for n in node[1])
        _, inner, low, high = node
        parts = [self._add(inner) for _ in range(low)]
        if high is None:
            empty, first, last = self._add(inner) if not low else parts.pop()
            self._link(last, first)
            parts.append((empty or not low, first, last))
        else:
            parts += [(True, *self._add(inner)[1:]) for _ in range(high - low)]
        return self._cat(parts)

    def reverse(self) -> Positions:
        """The automaton of the pattern read backwards."""
        other = object.__new__(Positions)
        other.sets, other.nullable, other.first, other.last = self.sets, self.nullable, self.last, self.first
        other.follow = [set() for _ in self.sets]
        for p, following in enumerate(self.follow):
            for q in following:
                other.follow[q].add(p)
        return other


@dataclass(frozen=True)
class Automaton:
    """classes: column of each byte; table: next state by state and column; accepts: a bit per pattern that ends in a state.
    State 0 is the start. Without restart a state `dead` has no way on (-1 where there is none)."""

    classes: np.ndarray
    table: np.ndarray
    accepts: np.ndarray
    dead: int


def _columns(patterns: Sequence[Positions]) -> tuple[np.ndarray, list[int]]:
    """Bytes that lie in the same sets share a column; a byte for each column."""
    kinds: dict[tuple, int] = {}
    classes = np.zeros(256, np.uint8)
    examples = []
    sets = list(dict.fromkeys(s for p in patterns for s in p.sets))
    for b in range(256):
        key = tuple(b in s for s in sets)
        if key not in kinds:
            kinds[key] = len(kinds)
            examples.append(b)
        classes[b] = kinds[key]
    return classes, examples


def determinize(patterns: Sequence[Positions], restart: bool) -> Automaton:
    """Subset construction over all patterns. restart: a match may begin at every byte (search), else only at the first."""
    classes, examples = _columns(patterns)
    begins = [(i, p) for i, pattern in enumerate(patterns) for p in pattern.first]
    start: frozenset = frozenset()
    number = {("start" if not restart else start): 0}
    todo = [start]
    table: list[list[int]] = []
    for done, state in enumerate(todo):
        reach = {(i, q) for i, p in state for q in patterns[i].follow[p]}
        if restart or done == 0:
            reach.update(begins)
        row = []
        for b in examples:
            after = frozenset((i, q) for i, q in reach if b in patterns[i].sets[q])
            if after not in number:
                number[after] = len(todo)
                todo.append(after)
            row.append(number[after])
        table.append(row)
    accepts = np.zeros(len(todo), np.uint16)
    for n, state in enumerate(todo):
        for i, p in state:
            if p in patterns[i].last:
                accepts[n] |= 1 << i
    dead = number.get(frozenset(), -1) if not restart else -1
    return minimize(Automaton(classes, np.array(table, np.int64), accepts, dead))


def minimize(automaton: Automaton) -> Automaton:
    """Merges states that accept the same patterns after every continuation, by refining the partition until it stands."""
    block = np.unique(automaton.accepts, return_inverse=True)[1].reshape(-1)
    while True:
        signs = np.column_stack([block, block[automaton.table]])
        finer = np.unique(signs, axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    # number blocks by their first state, so that the start stays 0
    order: dict[int, int] = {}
    for b in block.tolist():
        order.setdefault(b, len(order))
    block = np.array([order[b] for b in block.tolist()])
    first = np.array([np.flatnonzero(block == n)[0] for n in range(len(order))])
    dead = int(block[automaton.dead]) if automaton.dead >= 0 else -1
    return Automaton(automaton.classes, block[automaton.table[first]], automaton.accepts[first], dead)
