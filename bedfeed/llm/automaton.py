"""One deterministic automaton for many rules, with its transition arrays.

A rule is a head, a regular expression, and a tail, a run of at least so many characters of a class. Heads are read
with literals, escapes, classes, groups, `|`, `?`, `*`, `+` and `(?i:...)`. Each rule becomes an automaton by subset
construction: its states are the threads that are still in the head, oldest first, or the run of the tail. The first
thread that ends its head and reads a character of the tail wins and drops the others, so matches are leftmost and do
not overlap. All rules run side by side as one product automaton, which is minimised.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

END = 256  # the symbol after the last byte


@dataclass(frozen=True)
class Rule:
    kind: str
    head: str
    tail: str
    least: int


class _Nfa:
    """A head as states with empty moves and moves on sets of bytes; the last state accepts."""

    def __init__(self, pattern: str, backwards: bool = False) -> None:
        self.text, self.at, self.fold, self.back = pattern, 0, False, backwards
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.first, self.last = self._either()
        if self.at != len(pattern):
            raise ValueError(f"cannot read {pattern!r} from {self.at}")

    def _state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def _peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def _either(self) -> tuple[int, int]:
        options = [self._sequence()]
        while self._peek() == "|":
            self.at += 1
            options.append(self._sequence())
        if len(options) == 1:
            return options[0]
        first, last = self._state(), self._state()
        for a, b in options:
            self.empty[first].append(a)
            self.empty[b].append(last)
        return first, last

    def _sequence(self) -> tuple[int, int]:
        first = last = self._state()
        while self._peek() not in ("", "|", ")"):
            a, b = self._repeated()
            if self.back:
                self.empty[b].append(first)
                first = a
            else:
                self.empty[last].append(a)
                last = b
        return first, last

    def _repeated(self) -> tuple[int, int]:
        a, b = self._single()
        sign = self._peek()
        if sign and sign in "?*+":
            self.at += 1
            first, last = self._state(), self._state()
            self.empty[first].append(a)
            self.empty[b].append(last)
            if sign != "+":
                self.empty[first].append(last)
            if sign != "?":
                self.empty[b].append(a)
            return first, last
        return a, b

    def _single(self) -> tuple[int, int]:
        if self._peek() == "(":
            fold = self.fold
            self.at += 1
            if self.text.startswith("?i:", self.at):
                self.fold, self.at = True, self.at + 3
            elif self.text.startswith("?:", self.at):
                self.at += 2
            found = self._either()
            self.at += 1
            self.fold = fold
            return found
        chars, self.at = read_class(self.text, self.at)
        if self.fold:
            letters = "".join(map(chr, chars))
            chars = frozenset(map(ord, letters.lower() + letters.upper()))
        first, last = self._state(), self._state()
        self.moves[first].append((chars, last))
        return first, last

    def closure(self, states: set[int]) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return frozenset(found)

    def step(self, states: frozenset[int], byte: int) -> frozenset[int]:
        return self.closure({to for s in states for chars, to in self.moves[s] if byte in chars})

    def start(self) -> frozenset[int]:
        return self.closure({self.first})


def read_class(text: str, at: int) -> tuple[frozenset[int], int]:
    """The bytes of one character, escape or class, and the place after it."""

    def one(at: int) -> tuple[int, int]:
        if text[at] != "\\":
            return ord(text[at]), at + 1
        if text[at + 1] == "x":
            return int(text[at + 2 : at + 4], 16), at + 4
        return ord(text[at + 1]), at + 2

    if text[at] != "[":
        byte, at = one(at)
        return frozenset([byte]), at
    at, found = at + 1, set()
    while text[at] != "]":
        low, at = one(at)
        if text[at] == "-" and text[at + 1] != "]":
            high, at = one(at + 1)
            found.update(range(low, high + 1))
        else:
            found.add(low)
    return frozenset(found), at + 1


class _RuleAutomaton:
    """The states of one rule: ("head", threads) or ("tail", characters read, up to those that count)."""

    def __init__(self, rule: Rule) -> None:
        self.rule, self.nfa = rule, _Nfa(rule.head)
        self.tail = read_class(rule.tail, 0)[0]
        # Only a rule without a head has to count in its states; behind a head, runs are rare and measured later.
        self.least = rule.least if not rule.head else 1

    def alphabet(self) -> list[frozenset[int]]:
        return [self.tail, *[chars for moves in self.nfa.moves for chars, _ in moves]]

    def start(self) -> tuple:
        return ("head", (self.nfa.start(),))

    def step(self, state: tuple, byte: int) -> tuple[tuple, str]:
        """The next state and what happens on the way: "", "reach" when the run counts, "end" when such a run ends."""
        event = ""
        if state[0] == "tail":
            if byte in self.tail:
                read = min(state[1] + 1, self.least + 1)
                return ("tail", read), "reach" if read == self.least else ""
            event = "end" if state[1] >= self.least else ""
            state = self.start()
        threads, older = [], False
        for thread in state[1]:
            ahead = self.nfa.step(thread, byte)
            if self.nfa.last in thread and byte in self.tail:
                if older or ahead:
                    raise ValueError(f"rule {self.rule.kind}: head and tail can be told apart in more than one way")
                return ("tail", 1), "reach" if self.least == 1 else event
            if ahead:
                threads.append(ahead)
                older = True
        known: set[int] = set()
        kept = []
        for thread in [*threads, self.nfa.start()]:
            if thread - known:
                kept.append(frozenset(thread - known))
            known |= thread
        return ("head", tuple(kept)), event


class Automaton:
    """Transition arrays of all rules: `classes` maps bytes to symbols, `table[state + symbol]` gives the next state
    (times the number of symbols), or ~i when `events[i]` = (next state, [(rule, event), ...]) happens on the way."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        parts = [_RuleAutomaton(r) for r in rules]
        sets = [s for p in parts for s in p.alphabet()]
        marks = [tuple(byte in s for s in sets) for byte in range(257)]
        symbols = {m: i for i, m in enumerate(dict.fromkeys(marks))}
        self.classes = bytes(symbols[m] for m in marks[:256])
        self.end = len(symbols)
        probe = [marks.index(m) for m in symbols] + [END]
        width = len(probe)
        states = {tuple(p.start() for p in parts): 0}
        rows, todo = [], list(states)
        for state in todo:
            row = []
            for byte in probe:
                steps = [p.step(s, byte) for p, s in zip(parts, state, strict=True)]
                to = tuple(s for s, _ in steps)
                if to not in states:
                    states[to] = len(states)
                    todo.append(to)
                row.append((states[to], tuple((i, e) for i, (_, e) in enumerate(steps) if e)))
            rows.append(row)
        blocks, rows = _minimised(rows)
        self.states = len(rows)
        self.events: list[tuple[int, tuple[tuple[int, str], ...]]] = []
        known: dict[tuple, int] = {}
        self.table: list[int] = []
        for row in rows:
            for to, happened in row:
                if happened:
                    edge = (to * width, happened)
                    if edge not in known:
                        known[edge] = len(self.events)
                        self.events.append(edge)
                    self.table.append(~known[edge])
                else:
                    self.table.append(to * width)
        self.first = blocks[0] * width
        self._behind = [_Nfa(r.head, backwards=True) for r in rules]
        self._tails = [p.least for p in parts]

    def begin(self, rule: int, data: bytes, at: int, floor: int) -> int:
        """Where the head that ends before `at` begins, not before `floor`: its reversed expression is read backwards."""
        nfa = self._behind[rule]
        states, best = nfa.start(), at
        while at > floor and states:
            at -= 1
            states = nfa.step(states, data[at])
            if nfa.last in states:
                best = at
        return best

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        """(rule, start, end) of all matches in one pass over the bytes; positions are bytes."""
        table, state, found = self.table, self.first, []
        runs: dict[int, int] = {}
        floors: dict[int, int] = {}
        for at, symbol in enumerate(data.translate(self.classes) + bytes([self.end])):
            state = table[state + symbol]
            if state < 0:
                state, happened = self.events[~state]
                for rule, event in happened:
                    if event == "reach":
                        runs[rule] = at + 1 - self._tails[rule]
                    else:
                        begin = runs[rule]
                        if at - begin >= self.rules[rule].least:
                            found.append((rule, self.begin(rule, data, begin, floors.get(rule, 0)), at))
                        floors[rule] = at
        return found


def _minimised(rows: list[list[tuple[int, tuple]]]) -> tuple[np.ndarray, list[list[tuple[int, tuple]]]]:
    """The block of each state, and one row per block: states whose rows agree, block by block, are one."""
    labels: dict[tuple, int] = {}
    events = np.array([[labels.setdefault(e, len(labels)) for _, e in row] for row in rows])
    targets = np.array([[to for to, _ in row] for row in rows])
    block, count = np.zeros(len(rows), np.int64), 1
    while True:
        _, first, block = np.unique(np.hstack([events, block[targets], block[:, None]]), axis=0, return_index=True, return_inverse=True)
        block = block.reshape(-1)
        if len(first) == count:
            break
        count = len(first)
    return block, [[(int(block[to]), e) for to, e in rows[i]] for i in first]
