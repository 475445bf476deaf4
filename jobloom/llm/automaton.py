"""Rules as one deterministic automaton over bytes.

Regular expressions are read with the standard library's parser, turned into states
with empty moves, made deterministic by subset construction over classes of bytes
that no rule tells apart, and minimised by splitting blocks of states.
"""

from __future__ import annotations

import re
from re import _constants as op
from re import _parser as parser


class _Moves:
    """A nondeterministic automaton: byte moves and empty moves of numbered states."""

    def __init__(self):
        self.byte: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.byte.append([])
        self.empty.append([])
        return len(self.byte) - 1

    def add(self, items, start: int, reverse: bool) -> int:
        """Build `items` (a parsed sequence) from `start`; the state where it ends."""
        for what, value in reversed(list(items)) if reverse else items:
            start = self._one(what, value, start, reverse)
        return start

    def _one(self, what, value, start: int, reverse: bool) -> int:
        if what in (op.LITERAL, op.IN):
            end = self.state()
            self.byte[start].append((_bytes([(what, value)] if what is op.LITERAL else value), end))
            return end
        if what is op.SUBPATTERN:
            _, on, _, items = value
            if on & re.IGNORECASE:
                items = [_folded(x) for x in items]
            return self.add(items, start, reverse)
        if what is op.BRANCH:
            end = self.state()
            for items in value[1]:
                self.empty[self.add(items, start, reverse)].append(end)
            return end
        if what is op.MAX_REPEAT:
            least, most, items = value
            for _ in range(least):
                start = self.add(items, start, reverse)
            if most is op.MAXREPEAT:
                loop = self.state()
                self.empty[start].append(loop)
                self.empty[self.add(items, loop, reverse)].append(loop)
                return loop
            end = self.state()
            for _ in range(most - least):
                self.empty[start].append(end)
                start = self.add(items, start, reverse)
            self.empty[start].append(end)
            return end
        raise ValueError(f"rules may not use {what}")


def _folded(item):
    what, value = item
    if what is op.LITERAL and chr(value).isalpha():
        return op.IN, [(op.LITERAL, ord(chr(value).lower())), (op.LITERAL, ord(chr(value).upper()))]
    if what is op.BRANCH:
        return what, (value[0], [[_folded(x) for x in items] for items in value[1]])
    if what is op.MAX_REPEAT:
        return what, (*value[:2], [_folded(x) for x in value[2]])
    if what is op.SUBPATTERN:
        return what, (*value[:3], [_folded(x) for x in value[3]])
    return item


def _bytes(items) -> frozenset[int]:
    found: set[int] = set()
    for what, value in items:
        if what is op.LITERAL:
            found.add(value)
        elif what is op.RANGE:
            found.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"classes may not use {what}")
    if max(found) > 127:
        raise ValueError("rules are ASCII")
    return frozenset(found)


class Automaton:
    """Transition array of all `rules`: `step[256 * state + byte]` is 256 * next state.

    With `anywhere` a match may begin at each byte; with `reverse` rules are read from
    their end. `accepts[state]` has the numbers of the rules that match there; states
    from `first` on (times 256) accept some rule, those below none; `start` is the first state.
    """

    def __init__(self, rules: list[str], anywhere: bool = False, reverse: bool = False):
        moves = _Moves()
        begin = moves.state()
        ends = {}
        for number, rule in enumerate(rules):
            entry = moves.state()
            moves.empty[begin].append(entry)
            ends[moves.add(parser.parse(rule), entry, reverse)] = number
        table, accepts, start = self._subsets(moves, begin, ends, anywhere)
        table, accepts, start = self._smallest(table, accepts, start)
        order = sorted(range(len(table)), key=lambda s: bool(accepts[s]))
        at = {s: i for i, s in enumerate(order)}
        self.step = [256 * at[table[s][b]] for s in order for b in range(256)]
        self.accepts = [tuple(sorted(accepts[s])) for s in order]
        self.first = 256 * sum(not x for x in self.accepts)
        self.start = 256 * at[start]
        self.states = len(order)

    @staticmethod
    def _subsets(moves: _Moves, begin: int, ends: dict[int, int], anywhere: bool):
        reach: dict[int, frozenset[int]] = {}

        def closed(state: int) -> frozenset[int]:
            if state not in reach:
                seen, todo = {state}, [state]
                while todo:
                    for x in moves.empty[todo.pop()]:
                        if x not in seen:
                            seen.add(x)
                            todo.append(x)
                reach[state] = frozenset(s for s in seen if moves.byte[s] or s in ends)
            return reach[state]

        kinds: dict[tuple, int] = {}
        sets = sorted({chars for row in moves.byte for chars, _ in row}, key=sorted)
        of_byte = [kinds.setdefault(tuple(b in chars for chars in sets), len(kinds)) for b in range(256)]
        sample = [of_byte.index(k) for k in range(len(kinds))]
        first = closed(begin)
        number, todo, rows = {first: 0}, [first], []
        for states in todo:
            row = []
            for byte in sample:
                into: set[int] = set(first) if anywhere else set()
                for s in states:
                    for chars, end in moves.byte[s]:
                        if byte in chars:
                            into |= closed(end)
                key = frozenset(into)
                if key not in number:
                    number[key] = len(todo)
                    todo.append(key)
                row.append(number[key])
            rows.append([row[k] for k in of_byte])
        return rows, [frozenset(ends[s] for s in states if s in ends) for states in todo], 0

    @staticmethod
    def _smallest(table: list[list[int]], accepts: list[frozenset[int]], start: int):
        """Merge states that no text tells apart: blocks by accepted rules are split by where their bytes lead."""
        block = {}
        of = [block.setdefault(a, len(block)) for a in accepts]
        while True:
            split: dict[tuple, int] = {}
            new = [split.setdefault((of[s], *(of[x] for x in row)), len(split)) for s, row in enumerate(table)]
            if len(split) == len(set(of)):
                break
            of = new
        lead = {}
        for s, b in enumerate(of):
            lead.setdefault(b, s)
        names = {b: i for i, b in enumerate(lead)}
        rows = [[names[of[x]] for x in table[s]] for s in lead.values()]
        return rows, [accepts[s] for s in lead.values()], names[of[start]]


def longest(automaton: Automaton, data: bytes, at: int, to: int, back: bool = False) -> int:
    """Length of the longest match that begins at `at` and stays before `to`; with `back`, that ends before `at` and begins at `to` or later. -1: none."""
    state, step, best = automaton.start, automaton.step, -1
    if automaton.accepts[state >> 8]:
        best = 0
    for n, i in enumerate(range(at - 1, to - 1, -1) if back else range(at, to), 1):
        state = step[state + data[i]]
        if state >= automaton.first:
            best = n
        elif not state_alive(automaton, state):
            break
    return best


def state_alive(automaton: Automaton, state: int) -> bool:
    """False for the state that only leads to itself and accepts nothing."""
    dead = automaton.__dict__.get("_dead")
    if dead is None:
        dead = automaton._dead = {256 * s for s in range(automaton.states) if not automaton.accepts[s] and all(x == 256 * s for x in automaton.step[256 * s : 256 * s + 256])}
    return state not in dead
