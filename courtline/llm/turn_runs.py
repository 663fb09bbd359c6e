"""Cheapest edits of a conversation's rows: a run-length DP over min-plus transitions.

A row is a symbol, its role's class and its fault.  The roles' grammar,
``(s?(ua)+)?``, has four states: nothing yet, after a system row, after a user
row, after an assistant row.  A symbol's transition is the matrix of the least
costs to come from state to state over one such row, with any inserted rows
before it.  A run of r equal symbols advances the costs-to-go by the powers
1, 2, 4, ... of its matrix that make up r; the powers are kept per symbol.  The choices
are then unrolled forwards: of the edits that keep the least cost, the one with the
ASCII-least initial.  An initial fixes the next state, so this gives the least audit.
"""

from __future__ import annotations

from itertools import groupby, product

CLASSES = "suax"  # system, user, assistant, any other role
FAULTS = ("fine", "truncated", "blank", "duplicate")
FIRST_SYMBOL = ord("a")  # symbol: this + 4 * fault + class
GONE = 8  # blank and duplicate rows of any class, which must be deleted, step alike

#: Fixed costs of the edits.
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5

Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]

START, STATES = 0, range(4)
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})  # state -> class -> state
FORCED = tuple("uuau")  # the class of a reroled or inserted row
ONWARD = tuple(NEXT[p][FORCED[p]] for p in STATES)
FAR = 1 << 50
#: Least cost to end from a state: nothing and whole pairs are complete.
END: Vector = (0, 2 * INSERT, INSERT, 0)
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
CACHED_RUN = 64  # longest run whose choices are kept
CACHED = 100_000

_powers: dict[int, list[Matrix]] = {}
_choices: dict[tuple, tuple[str, int]] = {}


def kind(symbol: str) -> int:
    """The symbol's number among the GONE + 1 that step differently."""
    return min(ord(symbol) - FIRST_SYMBOL, GONE)


def edits(k: int, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits that consume a row, ASCII-least first."""
    found = [("D", DELETE, state)]
    if k < GONE:
        extra = UNFINISHED if k >= 4 else 0
        kept = NEXT[state].get(CLASSES[k % 4])
        if kept is not None:
            found.append(("K", extra, kept))
        found.append(("R", REROLE + extra, ONWARD[state]))
    return found


def transition(k: int) -> Matrix:
    rows = []
    for state in STATES:
        row, at = [FAR] * 4, state
        for inserted in range(3):  # a third insert comes back to a state passed
            for _, cost, after in edits(k, at):
                row[after] = min(row[after], inserted * INSERT + cost)
            at = ONWARD[at]
        rows.append(tuple(row))
    return tuple(rows)


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(x + y[q] for x, y in zip(row, b)) for q in STATES) for row in a)


def before(a: Matrix, togo: Vector) -> Vector:
    return tuple(min(x + y for x, y in zip(row, togo)) for row in a)


def powers(k: int, n: int) -> list[Matrix]:
    """The powers 1, 2, 4, ... of the transition, enough for a run of ``n``."""
    held = _powers.setdefault(k, [transition(k)])
    while n >> len(held):
        held.append(times(held[-1], held[-1]))
    return held


def advance(k: int, n: int, togo: Vector) -> Vector:
    """The costs-to-go before a run of ``n`` rows with ``togo`` behind it."""
    for bit, power in enumerate(powers(k, n)):
        if n >> bit & 1:
            togo = before(power, togo)
    return togo


def runs_of(symbols: str) -> list[tuple[int, int]]:
    return [(k, sum(1 for _ in same)) for k, same in groupby(map(kind, symbols))]


def matrix_of(symbols: str) -> Matrix:
    """The transition over all of ``symbols``."""
    whole: Matrix = tuple(tuple(0 if p == q else FAR for q in STATES) for p in STATES)
    for k, n in runs_of(symbols):
        for bit, power in enumerate(powers(k, n)):
            if n >> bit & 1:
                whole = times(whole, power)
    return whole


def _unroll(k: int, n: int, state: int, togo: Vector) -> tuple[str, int]:
    """Initials of the edits over a run from ``state``, and the state behind it."""
    steps, matrix = [togo], powers(k, 1)[0]
    for _ in range(n):
        steps.append(before(matrix, steps[-1]))
    out = []
    for left in range(n, 0, -1):
        now, later = steps[left], steps[left - 1]
        done = False
        while not done:
            delete, *others = edits(k, state)
            if delete[1] + later[state] == now[state]:
                out.append("D")
                break
            if INSERT + now[ONWARD[state]] == now[state]:
                out.append("I")
                state = ONWARD[state]
                continue
            for initial, cost, after in others:
                if cost + later[after] == now[state]:
                    out.append(initial)
                    state, done = after, True
                    break
    return "".join(out), state


def choose(k: int, n: int, state: int, togo: Vector) -> tuple[str, int]:
    if n > CACHED_RUN:
        return _unroll(k, n, state, togo)
    least = min(togo)
    key = (k, n, state, *(x - least for x in togo))
    if key not in _choices:
        if len(_choices) >= CACHED:
            _choices.clear()
        _choices[key] = _unroll(k, n, state, togo)
    return _choices[key]


def audit_of(symbols: str, togo: Vector = END, state: int = START, last: bool = True) -> tuple[str, int, int]:
    """Initials of the cheapest edits of ``symbols`` from ``state`` with ``togo`` behind
    them, their cost, and the state they lead to; ``last``: the closing inserts as well."""
    runs, behind = runs_of(symbols), [togo]
    for k, n in reversed(runs):
        behind.append(advance(k, n, behind[-1]))
    start, out = behind[-1][state], []
    for (k, n), after in zip(runs, reversed(behind[:-1])):
        letters, state = choose(k, n, state, after)
        out.append(letters)
    cost = start - togo[state]
    while last and END[state]:
        out.append("I")
        cost += INSERT
        state = ONWARD[state]
    return "".join(out), cost, state


def counts_of(symbols: str) -> tuple[int, int, int, int]:
    """Rows that are blank, duplicate and truncated; adjacent rows of illegal roles."""
    faults = [0, 0, 0, 0]
    for symbol in set(symbols):
        faults[(ord(symbol) - FIRST_SYMBOL) // 4] += symbols.count(symbol)
    roles = "".join(CLASSES[(ord(c) - FIRST_SYMBOL) % 4] for c in symbols)
    pairs = product(CLASSES, CLASSES)
    illegal = max(len(roles) - 1, 0) - sum(_adjacent(roles, x + y) for x, y in pairs if x + y in LEGAL)
    return faults[2], faults[3], faults[1], illegal


def _adjacent(roles: str, pair: str) -> int:
    return roles.count(pair)  # the two letters differ, so places do not overlap


class Replay:
    """Plays an audit's edits on rows that come one after the other."""

    def __init__(self) -> None:
        self.state, self.letters, self.at = START, "", 0

    def load(self, letters: str) -> None:
        self.letters, self.at = letters, 0

    def inserts(self) -> list[str]:
        """Lines of the rows that are inserted here."""
        lines = []
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            lines.append(self._forced(""))
            self.at += 1
        return lines

    def row(self, role: str, text: str) -> list[str]:
        """Lines that stand for a row: those inserted before it and its own, if it stays."""
        lines, letter = self.inserts(), self.letters[self.at]
        self.at += 1
        if letter == "K":
            self.state = NEXT[self.state][role[:1]]
            lines.append(f"{role}:{text}")
        elif letter == "R":
            lines.append(self._forced(text))
        return lines

    def _forced(self, text: str) -> str:
        name = NAMES[FORCED[self.state]]
        self.state = ONWARD[self.state]
        return f"{name}:{text}"
