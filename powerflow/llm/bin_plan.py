"""Which lengths share a sequence: a configuration linear program over the histogram of lengths.

A configuration is a multiset of length classes that fits a sequence; the program asks for the fewest
configurations, in fractions, that cover every class. Multiplicative weights solve it: a class's price falls with
how far it is covered, a knapsack dynamic program finds the configuration of the highest price, and that one
is added in the measure in which its scarcest class allows. Prices bound the optimum from below, so the weights
stop when the solution is close to it. Classes are single lengths, or, if there are more than ``CLASSES`` different
ones, neighbouring lengths of about the same number of tokens; their mean stands for them in the program. Lengths
below an eighth of the capacity stay out of the program, since they fill the room that the others leave.

Rounding turns the fractions into whole sequences of real lengths: for the classes of a configuration it takes the
lengths of which most are left, for its last place the longest that fits, and repeats that sequence until the
configuration or one of the lengths is used up. A sequence with more room than the small lengths are for is not
begun. What is left, longest first, goes where it leaves the least room. All steps handle alike sequences at once,
so their number follows the numbers of lengths and configurations, and not that of pieces.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np

CLASSES = 64
SMALL = 8  # lengths below the capacity over this fill up
STEP = 0.25
GAP = 0.01  # over the bound from prices at which the weights stop
ROUNDS = 3000


@dataclass
class Plan:
    """Where the pieces of each length go, by their rank from 0 among the pieces of that length.

    A row covers the ranks of its length from ``first_rank`` to the next row: ``copies`` of them go to each sequence,
    from ``first_sequence`` and, in the sequence, ``first_offset`` on. Rows are sorted by length and rank.
    """

    length: np.ndarray
    first_rank: np.ndarray
    first_sequence: np.ndarray
    copies: np.ndarray
    first_offset: np.ndarray
    before: np.ndarray  # pieces that are shorter than each length
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces."""
        begins = self.before[self.length] + self.first_rank
        row = np.searchsorted(begins, self.before[length] + rank, side="right") - 1
        nth = rank - self.first_rank[row]
        offset = self.first_offset[row] + nth % self.copies[row] * length
        return self.first_sequence[row] + nth // self.copies[row], offset


def best_configuration(sizes: np.ndarray, most: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """Copies of each class that fit the capacity and are worth most, at most ``most`` of each.

    Copies are bought in lots of 1, 2, 4, ... so that each lot is taken or left once.
    """
    worth = np.zeros(capacity + 1)
    lots: list[tuple[int, int, np.ndarray]] = []
    for number in np.flatnonzero(prices > 0).tolist():
        size, left, lot = int(sizes[number]), int(min(most[number], capacity // sizes[number])), 1
        while left > 0:
            lot = min(lot, left)
            width = lot * size
            option = worth[: capacity + 1 - width] + lot * prices[number]
            taken = np.zeros(capacity + 1, dtype=bool)
            np.greater(option, worth[width:] + 1e-15, out=taken[width:])
            worth[width:] = np.maximum(worth[width:], option)
            lots.append((number, lot, taken))
            left, lot = left - lot, 2 * lot
    copies = np.zeros(len(sizes), dtype=np.int64)
    room = capacity
    for number, lot, taken in reversed(lots):
        if taken[room]:
            copies[number] += lot
            room -= lot * int(sizes[number])
    return copies


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Configurations (rows) and how often each is used, in fractions, to cover the demand."""
    most = np.minimum(demand, capacity // sizes)
    covered = np.zeros(len(sizes))
    used: dict[bytes, float] = {}
    bound = total = 0.0
    for _ in range(ROUNDS):
        weight = np.exp(covered.min() - covered)
        prices = weight / demand
        copies = best_configuration(sizes, most, prices, capacity)
        bound = max(bound, float(weight.sum() / (copies * prices).sum()))
        on = copies > 0
        amount = STEP * float((demand[on] / copies[on]).min())
        used[copies.tobytes()] = used.get(copies.tobytes(), 0.0) + amount
        total += amount
        covered += copies * amount / demand
        if covered.min() * bound * (1 + GAP) >= total:
            break
    # a class that was never bought is left to the rounding
    scale = covered.min() or total / bound
    return np.array([np.frombuffer(key, dtype=np.int64) for key in used]), np.array(list(used.values())) / scale


def classes(histogram: np.ndarray, limit: int = CLASSES) -> np.ndarray:
    """Class of each length; lengths without pieces get the class of their longer neighbour."""
    lengths = np.flatnonzero(histogram)
    if len(lengths) <= limit:
        return np.searchsorted(lengths, np.arange(len(histogram)))
    tokens = np.cumsum(histogram * np.arange(len(histogram)))
    return np.minimum((tokens - 1).clip(0) * limit // tokens[-1], limit - 1).astype(np.int64)


class _Left:
    """Pieces left of each length."""

    def __init__(self, histogram: np.ndarray) -> None:
        self.count: list[int] = histogram.tolist()
        # the longest length up to each one of which pieces are left, found by halving paths
        self.up = list(range(len(self.count)))
        for length, n in enumerate(self.count):
            if not n and length:
                self.up[length] = length - 1

    def longest(self, room: int) -> int:
        """The longest length left that is at most ``room``; 0 if there is none."""
        up = self.up
        while up[room] != room:
            up[room] = up[up[room]]
            room = up[room]
        return room

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            self.up[length] = length - 1


class _Sequences:
    """Alike sequences with their lengths and the room left in them."""

    def __init__(self, left: _Left, capacity: int) -> None:
        self.left, self.capacity = left, capacity
        self.packed: list[tuple[dict[int, int], int]] = []
        self.open: dict[int, list[int]] = {}  # room -> places in ``packed``
        self.rooms: list[int] = []  # of ``open``, ascending

    def put(self, held: dict[int, int], n: int) -> None:
        room = self.capacity - sum(length * copies for length, copies in held.items())
        if room not in self.open:
            self.open[room] = []
            bisect.insort(self.rooms, room)
        self.open[room].append(len(self.packed))
        self.packed.append((held, n))

    def new(self, held: dict[int, int], most: int) -> int:
        """Begin alike sequences, as many as pieces are left for but at most ``most``."""
        n = min([most, *(self.left.count[length] // copies for length, copies in held.items())])
        for length, copies in held.items():
            self.left.take(length, n * copies)
        self.put(held, n)
        return n

    def best_fit(self, length: int) -> None:
        """All pieces left of a length, each where it leaves the least room."""
        while n := self.left.count[length]:
            at = bisect.bisect_left(self.rooms, length)
            if at == len(self.rooms):
                fit = min(n, self.capacity // length)
                self.new({length: fit}, n // fit)
                continue
            room = self.rooms[at]
            places = self.open[room]
            held, alike = self.packed[place := places.pop()]
            if not places:
                del self.open[room]
                self.rooms.pop(at)
            copies = min(n, room // length)
            filled = min(alike, n // copies)
            self.left.take(length, filled * copies)
            self.packed[place] = (held, 0)
            self.put({**held, length: held.get(length, 0) + copies}, filled)
            if alike > filled:
                self.put(held, alike - filled)


def _lengths(left: _Left, members: list[list[int]], copies: np.ndarray, capacity: int) -> dict[int, int]:
    """One sequence of the configuration: from the longest class, of each the lengths of which most are left.

    The last place goes to the longest length that fits. Lengths that do not fit are left out.
    """
    held: dict[int, int] = {}
    room, places = capacity, int(copies.sum())
    for number in np.flatnonzero(copies)[::-1].tolist():
        for _ in range(int(copies[number])):
            places -= 1
            if places or not held:
                length = max(members[number], key=lambda own: left.count[own] - held.get(own, 0))
            else:
                length = left.longest(room)
            if members[0][0] <= length <= room and left.count[length] > held.get(length, 0):
                held[length] = held.get(length, 0) + 1
                room -= length
    return held


def pack(histogram: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Sequences as copies of each length, and how many sequences are alike. ``histogram[l]`` counts length ``l``."""
    if histogram[:1].any() or len(histogram) > capacity + 1:
        raise ValueError("lengths must be from 1 to the capacity")
    count = np.concatenate([histogram, np.zeros(capacity + 1 - len(histogram), dtype=np.int64)]).astype(np.int64)
    left = _Left(count)
    sequences = _Sequences(left, capacity)
    rest = count.copy()
    rest[: max(1, capacity // SMALL)] = 0
    rest[capacity] = 0
    if rest.any():
        of = classes(rest)
        demand = np.bincount(of, weights=rest).astype(np.int64)
        tokens = np.bincount(of, weights=rest * np.arange(capacity + 1))
        kept = np.flatnonzero(demand)
        sizes = np.rint(tokens[kept] / demand[kept]).astype(np.int64)
        configurations, times = solve(sizes, demand[kept], capacity)
        members = [np.flatnonzero((of == number) & (rest > 0)).tolist() for number in kept.tolist()]
        for row in np.lexsort((-times, -(configurations * sizes).max(axis=1))).tolist():
            budget = int(np.rint(times[row]))
            while budget > 0 and (held := _lengths(left, members, configurations[row], capacity)):
                if (capacity - sum(length * copies for length, copies in held.items())) * SMALL > capacity:
                    break
                budget -= sequences.new(held, budget)
    while longest := left.longest(capacity):
        sequences.best_fit(longest)
    return [(held, n) for held, n in sequences.packed if n]


def plan(histogram: np.ndarray, capacity: int) -> Plan:
    """Ranges of ranks of each length with their sequences and offsets; longer pieces come first in a sequence."""
    rows, ranks, sequences = [], {}, 0
    for held, n in pack(histogram, capacity):
        offset = 0
        for length in sorted(held, reverse=True):
            copies = held[length]
            rows.append((length, ranks.get(length, 0), sequences, copies, offset))
            ranks[length] = ranks.get(length, 0) + copies * n
            offset += copies * length
        sequences += n
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    before = np.cumsum(histogram) - histogram
    return Plan(*table.T, before, sequences)
