"""Deterministic automata over bytes: rule patterns -> subset construction -> minimised transition arrays.

The pattern notation covers what secret rules need: literals, ``\\xHH`` and escaped literals, classes with
ranges, groups, ``|``, and the repeats ``? * + {m} {m,}``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


class Builder:
    """Nondeterministic automaton: per state the byte moves and the free moves."""

    def __init__(self):
        self.moves: list[list[tuple[frozenset, int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def add(self, tree, start: int, reverse: bool) -> int:
        """Append ``tree`` after ``start``; returns its end state."""
        kind, *rest = tree
        if kind == "set":
            end = self.state()
            self.moves[start].append((rest[0], end))
            return end
        if kind == "seq":
            for part in (reversed(rest[0]) if reverse else rest[0]):
                start = self.add(part, start, reverse)
            return start
        if kind == "any":
            end = self.state()
            for part in rest[0]:
                begin = self.state()
                self.free[start].append(begin)
                self.free[self.add(part, begin, reverse)].append(end)
            return end
        part, least, most = rest
        for _ in range(least):
            start = self.add(part, start, reverse)
        if most is None:
            loop = self.state()
            self.free[start].append(loop)
            self.free[self.add(part, loop, reverse)].append(loop)
            return loop
        for _ in range(most - least):
            end = self.add(part, start, reverse)
            self.free[start].append(end)
            start = end
        return start


def parse(pattern: str, any_case: bool = False):
    """Tree of a pattern: ("set", bytes), ("seq", parts), ("any", parts) or ("rep", part, least, most)."""
    at = 0

    def literal() -> int:
        nonlocal at
        c = pattern[at]
        at += 1
        if c == "\\":
            c, at = pattern[at], at + 1
            if c == "x":
                at += 2
                return int(pattern[at - 2:at], 16)
        return ord(c)

    def cased(members) -> tuple:
        if any_case:
            members = {ord(x) for b in members for x in (chr(b).lower(), chr(b).upper())}
        return ("set", frozenset(members))

    def atom():
        nonlocal at
        if pattern[at] == "(":
            at += 1
            tree = branches()
            at += 1
            return tree
        if pattern[at] != "[":
            return cased({literal()})
        at += 1
        members: set[int] = set()
        while pattern[at] != "]":
            lo = hi = literal()
            if pattern[at] == "-" and pattern[at + 1] != "]":
                at += 1
                hi = literal()
            members |= set(range(lo, hi + 1))
        at += 1
        return cased(members)

    def sequence():
        nonlocal at
        parts = []
        while at < len(pattern) and pattern[at] not in "|)":
            part = atom()
            while at < len(pattern) and pattern[at] in "?*+{":
                c = pattern[at]
                at += 1
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None), "{": (0, 0)}[c]
                if c == "{":
                    close = pattern.index("}", at)
                    low, comma, _ = pattern[at:close].partition(",")
                    least, most, at = int(low), None if comma else int(low), close + 1
                part = ("rep", part, least, most)
            parts.append(part)
        return ("seq", parts)

    def branches():
        nonlocal at
        found = [sequence()]
        while at < len(pattern) and pattern[at] == "|":
            at += 1
            found.append(sequence())
        return found[0] if len(found) == 1 else ("any", found)

    tree = branches()
    if at != len(pattern):
        raise ValueError(f"unbalanced pattern {pattern!r}")
    return tree


@dataclass
class Automaton:
    """table[state * 256 + byte] is the next state; accepts[state] has a bit for each rule matched there.

    States are numbered so that the accepting ones come last, from ``first_accept`` on; 0 is the start.
    """

    table: np.ndarray
    accepts: np.ndarray
    first_accept: int

    def rows(self) -> list[list[int]]:
        return self.table.reshape(-1, 256).tolist()


def compile_rules(trees: list, anywhere: bool, reverse: bool = False) -> Automaton:
    """One minimal automaton for all rules.  ``anywhere``: a match may begin at every byte."""
    nfa = Builder()
    root = nfa.state()
    ends = {}
    for k, tree in enumerate(trees):
        begin = nfa.state()
        nfa.free[root].append(begin)
        ends[nfa.add(tree, begin, reverse)] = k

    def closure(states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for s in nfa.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    # bytes that no set tells apart share a column
    sets = {m for moves in nfa.moves for m, _ in moves}
    kinds: dict[tuple, int] = {}
    column = np.array([kinds.setdefault(tuple(b in m for m in sets), len(kinds)) for b in range(256)])
    sample = [int(np.flatnonzero(column == k)[0]) for k in range(len(kinds))]
    start = closure([root])
    number, order, table = {start: 0}, [start], []
    for current in order:  # grows while it is walked
        row = []
        for b in sample:
            step = {t for s in current for m, t in nfa.moves[s] if b in m}
            target = closure(step | ({root} if anywhere else set()))
            if target not in number:
                number[target] = len(order)
                order.append(target)
            row.append(number[target])
        table.append(row)
    moves = np.array(table)
    accepts = np.array([sum({1 << ends[s] for s in states if s in ends}) for states in order], dtype=np.int64)
    block = np.unique(accepts, return_inverse=True)[1].reshape(-1)
    while True:  # refine until states of a block agree on the blocks they lead to
        finer = np.unique(np.column_stack([block, block[moves]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    member = np.unique(block, return_index=True)[1]
    rank = sorted(range(len(member)), key=lambda b: (accepts[member[b]] != 0, b != block[0], member[b]))
    if accepts[0]:
        raise ValueError("a rule matches the empty string")
    new = np.empty(len(rank), dtype=np.int64)
    new[rank] = np.arange(len(rank))
    member = member[rank]
    return Automaton(new[block[moves[member]]][:, column].astype(np.int32).ravel(), accepts[member], int((accepts[member] == 0).sum()))
