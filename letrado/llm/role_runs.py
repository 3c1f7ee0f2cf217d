"""Cheapest repair of a sequence of conversation turns as a min-plus automaton.

What has been written so far is one of four states: nothing, only a system turn,
a user turn last, an assistant turn last.  A turn's symbol says which letter its
role gives and what is wrong with it.  One symbol is a min-plus transition
matrix over the states, insertions included; a run of n equal symbols is its
n-th power, put together from cached binary powers.  ``after`` in this module
is the vector of least costs of all that follows, by state.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import groupby

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
INF = float("inf")
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 2, 5, 1, 5
#: symbols: 0 must be deleted; 1-4 a sound turn of role s, u, a, other; 5-8 the same, truncated
MUST_DELETE, LETTERS, TRUNCATED_FROM = 0, "sua", 5
KEEP = {(EMPTY, 1): SYSTEM, (EMPTY, 2): USER, (SYSTEM, 2): USER, (USER, 3): ASSISTANT, (ASSISTANT, 2): USER}
#: the state after the one user or assistant turn that may stand next
NEXT = (USER, USER, ASSISTANT, USER)
#: (su)a pairs must be whole at the end
END = (0.0, INF, INF, 0.0)


def symbol(role: str, must_delete: bool, truncated: bool) -> int:
    if must_delete:
        return MUST_DELETE
    letter = LETTERS.find(role[0]) if role else -1
    return (letter + 1 if letter >= 0 else 4) + (4 if truncated else 0)


def _edits(sym: int, state: int) -> list[tuple[str, float, int]]:
    """(initial, cost, next state) of the edits that use up one turn, ASCII-least first."""
    out = [("D", float(DELETE_COST), state)]
    if sym != MUST_DELETE:
        extra = TRUNCATED_COST if sym >= TRUNCATED_FROM else 0
        letter = (sym - 1) % 4 + 1
        if (state, letter) in KEEP:
            out.append(("K", float(extra), KEEP[state, letter]))
        out.append(("R", float(REROLE_COST + extra), NEXT[state]))
    return out


def times(a, b):
    """Min-plus product of two matrices."""
    return tuple(tuple(min(a[i][k] + b[k][j] for k in STATES) for j in STATES) for i in STATES)


def apply(matrix, after):
    """Min-plus product of a matrix and the costs of what follows."""
    return tuple(min(row[k] + after[k] for k in STATES) for row in matrix)


IDENTITY = tuple(tuple(0.0 if i == j else INF for j in STATES) for i in STATES)


def _inserts():
    one = tuple(tuple(0.0 if i == j else float(INSERT_COST) if NEXT[i] == j else INF for j in STATES) for i in STATES)
    return times(one, times(one, one))


INSERTS = _inserts()


@lru_cache(maxsize=None)      # 9 symbols times the bits of a run's length
def power(sym: int, bit: int):
    """The transition of 2**bit turns of one symbol."""
    if bit:
        half = power(sym, bit - 1)
        return times(half, half)
    step = [[INF] * 4 for _ in STATES]
    for state in STATES:
        for _, cost, then in _edits(sym, state):
            step[state][then] = min(step[state][then], cost)
    return times(INSERTS, step)


def runs(symbols: bytes) -> list[tuple[int, int]]:
    return [(sym, sum(1 for _ in same)) for sym, same in groupby(symbols)]


def over_run(sym: int, n: int, after):
    """Costs before a run of n equal symbols."""
    for bit in range(n.bit_length()):
        if n >> bit & 1:
            after = apply(power(sym, bit), after)
    return after


def transition(symbols: bytes):
    """The transition of a whole sequence."""
    out = IDENTITY
    for sym, n in runs(symbols):
        for bit in range(n.bit_length()):
            if n >> bit & 1:
                out = times(out, power(sym, bit))
    return out


#: costs by state before the end of a conversation: what is missing may still be inserted
AT_END = apply(INSERTS, END)


@lru_cache(maxsize=100_000)
def _choice(sym: int, state: int, before, after) -> tuple[str, int]:
    """The ASCII-least cheapest edits up to and with this turn, and the state they lead to."""
    done = ""
    while True:
        for initial, cost, then in _edits(sym, state):
            if initial == "D" and cost + after[then] == before[state]:
                return done + "D", then
        if INSERT_COST + before[NEXT[state]] == before[state]:
            done, state = done + "I", NEXT[state]
            continue
        for initial, cost, then in _edits(sym, state):
            if initial != "D" and cost + after[then] == before[state]:
                return done + initial, then
        raise AssertionError("no edit reaches the least cost")


def _relative(costs):
    least = min(costs)
    return tuple(c - least for c in costs), least


@lru_cache(maxsize=100_000)
def _step(sym: int, after):
    """(costs before one turn, the same less their least) for costs whose least is 0."""
    return apply(power(sym, 0), after)


def unroll(symbols: bytes, after, state: int) -> tuple[str, int]:
    """The ASCII-least cheapest edits of a sequence that starts in ``state``, and the state they lead to."""
    spans, cut = [], after
    for sym, n in reversed(runs(symbols)):          # from run to run by binary powers
        spans.append((sym, n, _relative(cut)[0]))
        cut = over_run(sym, n, cut)
    out = []
    for sym, n, behind in reversed(spans):
        steps = [behind]                            # inside a run turn by turn
        for _ in range(n):
            steps.append(_relative(_step(sym, steps[-1]))[0])
        for left in range(n, 0, -1):
            edit, state = _choice(sym, state, _step(sym, steps[left - 1]), steps[left - 1])
            out.append(edit)
    return "".join(out), state


def closing(state: int) -> str:
    """The insertions that end a conversation in ``state``."""
    out = ""
    while AT_END[state]:
        out, state = out + "I", NEXT[state]
    return out


@lru_cache(maxsize=200_000)
def _short(symbols: bytes) -> tuple[str, int]:
    return _whole(symbols)


def _whole(symbols: bytes) -> tuple[str, int]:
    cost = AT_END
    for sym, n in reversed(runs(symbols)):
        cost = over_run(sym, n, cost)
    edits, state = unroll(symbols, AT_END, EMPTY)
    return edits + closing(state), int(cost[EMPTY])


def repair(symbols: bytes) -> tuple[str, int]:
    """(audit, cost) of a whole conversation; short ones are remembered."""
    return _short(symbols) if len(symbols) <= 32 else _whole(symbols)


def write(edits: str, roles: list[str], texts: list[str], state: int) -> list[str]:
    """The repaired ``role:text`` turns that ``edits`` make of the given ones from ``state`` on."""
    out, at = [], 0
    for edit in edits:
        if edit == "K":
            out.append(f"{roles[at]}:{texts[at]}")
            state = KEEP[state, LETTERS.find(roles[at][0]) + 1]
        elif edit != "D":
            state = NEXT[state]
            out.append(f"{'assistant' if state == ASSISTANT else 'user'}:{texts[at] if edit == 'R' else ''}")
        at += edit != "I"
    return out
