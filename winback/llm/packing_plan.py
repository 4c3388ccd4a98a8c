"""Plan of a packing from counts of lengths alone.

A plan is made of lengths and how often they occur, at most one entry per possible
length, so its cost depends on the capacity and never on the number of documents. It
says for each length which occurrences go to which sequences, as runs.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from typing import NamedTuple

import numpy as np


class Run(NamedTuple):
    """Occurrences first..stop-1 of a length: `each` go to every sequence from `sequence`
    on, one after the other from `offset`."""

    length: int
    first: int
    stop: int
    each: int
    sequence: int
    offset: int


def groups_of(counts: Mapping[int, int], groups: int) -> list[list[list[int]]]:
    """Lengths in falling order, dealt to `groups` groups of equal cardinality.

    A group is a list of [length, occurrences]; its first length is the largest. A length
    may be shared by neighbouring groups.
    """
    total = sum(counts.values())
    if not total:
        return []
    size = -(-total // groups)
    out: list[list[list[int]]] = [[]]
    room = size
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                out.append([])
                room = size
            take = min(room, left)
            out[-1].append([length, take])
            room, left = room - take, left - take
    return out


def _best_pattern(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """The pattern of sizes within the capacity that is worth most (unbounded knapsack)."""
    worth = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    useful = np.flatnonzero(prices > 1e-12)
    useful = useful[np.argsort(sizes[useful], kind="stable")]
    steps, gains = sizes[useful], prices[useful]
    for room in range(1, capacity + 1):
        worth[room] = worth[room - 1]
        fits = int(np.searchsorted(steps, room, "right"))
        if fits:
            values = worth[room - steps[:fits]] + gains[:fits]
            best = int(values.argmax())
            if values[best] > worth[room] + 1e-12:
                worth[room], last[room] = values[best], useful[best]
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            pattern[last[room]] += 1
            room -= int(sizes[last[room]])
    return pattern


def configurations(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, steps: int = 2_000
) -> tuple[np.ndarray, np.ndarray]:
    """Few-size cutting problem: patterns (columns) and how often each is used.

    Revised simplex over patterns that a knapsack finds when needed. The counts are the
    relaxation's, so at most as many patterns as sizes are used; `plan` rounds them down.
    """
    n = len(sizes)
    patterns = np.diag(capacity // sizes).astype(float)
    amounts = demand / np.diag(patterns)
    for _ in range(steps):
        prices = np.linalg.solve(patterns.T, np.ones(n))
        column = _best_pattern(sizes, prices, capacity).astype(float)
        if column @ prices <= 1 + 1e-7:
            break
        change = np.linalg.solve(patterns, column)
        rising = change > 1e-9
        ratios = np.full(n, np.inf)
        ratios[rising] = amounts[rising] / change[rising]
        leaves = int(ratios.argmin())
        step = ratios[leaves]
        amounts = np.maximum(amounts - step * change, 0)
        amounts[leaves] = step
        patterns[:, leaves] = column
    return patterns.astype(np.int64), amounts


class _Bins:
    """Sequences by the room they have left, as runs of sequence numbers."""

    def __init__(self, capacity: int):
        self.capacity, self.next = capacity, 0
        self.rooms: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def open(self, n: int) -> int:
        first, self.next = self.next, self.next + n
        return first

    def put(self, room: int, first: int, n: int) -> None:
        if n and room:
            self.rooms[room].append((first, n))


def plan(
    counts: Mapping[int, int], capacity: int, groups: int = 40, small: float = 1 / 16
) -> tuple[list[Run], int]:
    """Runs that place every occurrence, and the number of sequences.

    Lengths above `small` of the capacity are rounded up within `groups` groups of equal
    cardinality, the few rounded sizes are packed by optimised configurations, actual
    lengths take the places of their group, and everything else is packed best-fit, longest
    first, into the room left and then into new sequences.
    """
    left = {int(k): int(v) for k, v in counts.items() if v > 0}
    if any(not 0 < length <= capacity for length in left):
        raise ValueError("a piece is empty or longer than the capacity")
    runs: list[Run] = []
    used: dict[int, int] = defaultdict(int)
    bins = _Bins(capacity)

    def place(length: int, sequences: int, each: int, sequence: int, offset: int) -> None:
        first = used[length]
        used[length] = first + sequences * each
        left[length] -= sequences * each
        runs.append(Run(length, first, used[length], each, sequence, offset))

    large = {k: v for k, v in left.items() if k > capacity * small}
    grouped = groups_of(large, groups)
    if grouped:
        sizes = np.array([group[0][0] for group in grouped])
        # Groups of one rounded size are one size of the problem.
        distinct, of = np.unique(sizes, return_inverse=True)
        demand = np.zeros(len(distinct))
        queues: list[list[list[int]]] = [[] for _ in distinct]
        for group, at in zip(grouped, of):
            demand[at] += sum(n for _, n in group)
            queues[at] += group
        patterns, amounts = configurations(distinct, demand, capacity)
        for pattern, amount in zip(patterns.T, np.floor(amounts + 1e-6).astype(int).tolist()):
            wanted = [(int(i), int(pattern[i])) for i in np.flatnonzero(pattern)[::-1]]
            while amount:
                # As many sequences as the next actual lengths allow without a change.
                ahead = [queues[i][0][1] // k if queues[i] else 0 for i, k in wanted]
                many = max(1, min(amount, *ahead))
                first, offset = bins.open(many), 0
                for i, k in wanted:
                    need = k
                    while need and queues[i]:
                        length, there = queues[i][0]
                        each = min(need, there // many)
                        place(length, many, each, first, offset)
                        offset, need = offset + each * length, need - each
                        queues[i][0][1] -= each * many
                        if not queues[i][0][1]:
                            queues[i].pop(0)
                bins.put(capacity - offset, first, many)
                amount -= many
    for length in sorted(left, reverse=True):
        while left[length]:
            room = next((r for r in range(length, capacity + 1) if bins.rooms[r]), None)
            if room is None:
                room, each = capacity, capacity // length
                bins.put(room, *(bins.open(n := -(-left[length] // each)), n))
            first, n = bins.rooms[room].pop()
            each = room // length
            whole = min(n, left[length] // each)
            if whole:
                place(length, whole, each, first, capacity - room)
                bins.put(room - each * length, first, whole)
            else:
                each, whole = left[length], 1
                place(length, 1, each, first, capacity - room)
                bins.put(room - each * length, first, 1)
            bins.put(room, first + whole, n - whole)
    return runs, bins.next


# Groups, and the share of the capacity above which a length is large.
TRIALS = ((40, 1 / 2), (40, 1 / 3), (40, 1 / 4), (40, 1 / 8))


def best_plan(
    counts: Mapping[int, int],
    capacity: int,
    trials: tuple[tuple[int, float], ...] = TRIALS,
) -> tuple[list[Run], int]:
    """The plan with the fewest sequences over a few ways to draw the line of large ones."""
    return min((plan(counts, capacity, *trial) for trial in trials), key=lambda found: found[1])
