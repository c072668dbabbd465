"""Cheapest repairs of a sequence of turns, by a search from both ends of an edit lattice.

A node of the lattice is (turns read, state of the grammar). The grammar of role
initials, ``(s?(ua)+)?``, has four states; in each of them one role can come next, a
system turn only at the very start. Edits are the arcs: Keep costs 0, Rerole 2, Delete 3,
Insert 2, and a truncated turn that stays costs 1 more. An audit spells a path by the
edits' initials, and tells it: the states follow from it.

Of two equally cheap paths to one node neither audit begins the other, since what follows
would be inserts, which cost. So the least audit of a path is made of least audits, and
labels (cost, audit) can be compared wherever paths meet.
"""

from __future__ import annotations

from heapq import heappop, heappush
from math import inf
from typing import NamedTuple

START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
# The role that comes next in each state, and the state after it.
NEXT = ("user", "user", "assistant", "user")
AFTER = (USER, USER, ASSISTANT, USER)
BEFORE = ((), (), (START, SYSTEM, ASSISTANT), (USER,))
KEEP, REROLE, DELETE, INSERT = "KRDI"


class Turn(NamedTuple):
    """What the lattice sees of a turn."""

    initial: str
    faulty: bool  # blank or duplicate: must go
    truncated: bool


def _kept(state: int, initial: str) -> int | None:
    """The state after a turn is kept, if it may be."""
    if state == START and initial == "s":
        return SYSTEM
    return AFTER[state] if initial and initial == NEXT[state][0] else None


class _Side:
    """One of the two searches: labels, and nodes open by cost, those nearer its end last."""

    def __init__(self, nodes, way: int) -> None:
        self.way, self.labels, self.open, self.closed = way, {}, [], set()
        for node in nodes:
            self.reach(node, 0, "")

    def reach(self, node: tuple[int, int], cost: int, audit: str) -> None:
        known = self.labels.get(node)
        if known is None or (cost, audit) < known:
            self.labels[node] = (cost, audit)
            if known is None or cost < known[0]:
                heappush(self.open, (cost, self.way * node[0], node))

    def least(self) -> float:
        while self.open and self.open[0][2] in self.closed:
            heappop(self.open)
        return self.open[0][0] if self.open else inf


def repair(
    turns: list[Turn], start: int = START, ends: tuple[int, ...] = ENDS, tail: bool = True
) -> tuple[int, str] | None:
    """The least cost and its least audit; without ``tail`` nothing is inserted at the end.

    Two heaps search from the start and from the ends until no open pair of nodes can be
    as cheap as the best path found. Every node that both have then reached at just that
    cost is a crossing; the least concatenated audit over all crossings is the answer.
    """
    n = len(turns)
    ahead = _Side([(0, start)], 1)
    # Arcs that cost nothing read a turn, so at one cost nodes go by the turns read.
    back = _Side([(n, end) for end in ends], -1)
    best = inf

    def forward(node, cost, audit):
        i, state = node
        if i < n or tail:
            ahead.reach((i, AFTER[state]), cost + 2, audit + INSERT)
        if i == n:
            return
        turn = turns[i]
        ahead.reach((i + 1, state), cost + 3, audit + DELETE)
        if not turn.faulty:
            ahead.reach((i + 1, AFTER[state]), cost + 2 + turn.truncated, audit + REROLE)
            kept = _kept(state, turn.initial)
            if kept is not None:
                ahead.reach((i + 1, kept), cost + turn.truncated, audit + KEEP)

    def backward(node, cost, audit):
        i, state = node
        if i < n or tail:
            for before in BEFORE[state]:
                back.reach((i, before), cost + 2, INSERT + audit)
        if i == 0:
            return
        turn = turns[i - 1]
        back.reach((i - 1, state), cost + 3, DELETE + audit)
        if turn.faulty:
            return
        for before in BEFORE[state]:
            back.reach((i - 1, before), cost + 2 + turn.truncated, REROLE + audit)
        for before in range(4):
            if _kept(before, turn.initial) == state:
                back.reach((i - 1, before), cost + turn.truncated, KEEP + audit)

    while True:
        low, high = ahead.least(), back.least()
        if low + high > best or (low == inf and high == inf):
            break
        side, other, spread = (ahead, back, forward) if low <= high else (back, ahead, backward)
        node = heappop(side.open)[2]
        side.closed.add(node)
        cost, audit = side.labels[node]
        spread(node, cost, audit)
        if node in other.labels:
            best = min(best, cost + other.labels[node][0])
    crossings = [
        audit + back.labels[node][1]
        for node, (cost, audit) in ahead.labels.items()
        if node in back.labels and cost + back.labels[node][0] == best
    ]
    return (int(best), min(crossings)) if crossings else None


def states(turns: list[Turn], audit: str, start: int = START) -> list[int]:
    """The state before each edit of an audit, and the last one."""
    at, state, passed = 0, start, [start]
    for edit in audit:
        if edit == KEEP:
            state = _kept(state, turns[at].initial)
        elif edit != DELETE:
            state = AFTER[state]
        at += edit != INSERT
        passed.append(state)
    return passed


def repaired(
    turns: list[Turn], rows: list[tuple[str, str]], audit: str, start: int = START
) -> list[tuple[str, str]]:
    """The (role, text) rows that an audit leaves."""
    out, at = [], 0
    for state, edit in zip(states(turns, audit, start), audit, strict=False):
        if edit == INSERT:
            out.append((NEXT[state], ""))
            continue
        if edit == KEEP:
            out.append(rows[at])
        elif edit == REROLE:
            out.append((NEXT[state], rows[at][1]))
        at += 1
    return out
