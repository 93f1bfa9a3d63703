"""Packing lengths into equal sequences by linear grouping, on counts of lengths alone.

There are at most ``capacity`` different lengths, however many documents have them. The plan is therefore
made from a table of bounded size: it says for ranges of ranks (the how-manieth document of its length) to
which sequences and offsets they go, and never names a document.

1. Lengths of ``large`` and more are sorted and cut into groups of equally many documents; every group
   counts as its longest length.
2. Sequences are filled with such sizes by configurations, chosen by a linear program whose columns are
   found by a knapsack over the capacity, and used a whole number of times.
3. The documents themselves take the places of their group. What rounding left of each sequence is known.
4. Documents that no whole configuration took, then the small ones, longest first, go where the least
   room stays free.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np


class Range(NamedTuple):
    """Documents of ``length`` with ranks from ``rank``: ``each`` of them, one behind the other from
    ``offset``, in each of ``sequences`` sequences from number ``sequence``."""

    length: int
    rank: int
    each: int
    sequences: int
    sequence: int
    offset: int


@dataclass(frozen=True)
class Grouping:
    """``capacity`` of a sequence, and what is tried in turn: (share, groups) says that lengths of
    ``capacity / share`` and more are cut into so many groups.

    Few large lengths leave more small documents to fill what rounding wastes; many groups round less. The
    plan with the fewest sequences is taken, or the first that needs at most one in 10,000 (or one at
    all) more than all lengths end to end.
    """

    capacity: int = 2048
    tries: tuple[tuple[int, int], ...] = ((2, 24), (3, 96), (6, 48), (6, 96))


class _Queue:
    """Documents of one group, shortest first, as (length, first rank, how many)."""

    def __init__(self, runs: list[tuple[int, int, int]]):
        self._runs = runs[::-1]

    def take(self, n: int) -> list[tuple[int, int, int]]:
        taken = []
        while n:
            length, rank, count = self._runs.pop()
            if count > n:
                self._runs.append((length, rank + n, count - n))
                count = n
            taken.append((length, rank, count))
            n -= count
        return taken

    def rest(self) -> list[tuple[int, int, int]]:
        return self._runs[::-1]


def plan(counts: Mapping[int, int], grouping: Grouping = Grouping()) -> list[Range]:
    """Ranges that place every document: ``counts`` tells how many there are of each length."""
    if any(not 0 < length <= grouping.capacity for length in counts):
        raise ValueError(f"a length outside 1 to {grouping.capacity}")
    fewest = -(-sum(length * n for length, n in counts.items()) // grouping.capacity)
    best, best_used = [], None
    for share, groups in grouping.tries:
        ranges, used = _planned(dict(counts), grouping.capacity, share, groups)
        if best_used is None or used < best_used:
            best, best_used = ranges, used
        if best_used <= fewest + max(1, fewest // 10_000):
            break
    return best


def _planned(
    counts: dict[int, int], capacity: int, share: int, groups: int
) -> tuple[list[Range], int]:
    """(the ranges, how many sequences they use)."""
    full = counts.pop(capacity, 0)
    ranges = [Range(capacity, 0, 1, full, 0, 0)] if full else []
    least = -(-capacity // share)
    sizes, queues = _grouped({n: c for n, c in counts.items() if n >= least and c}, groups)
    used = full
    rooms: dict[int, list[tuple[int, int]]] = {}
    totals = np.array([sum(c for _, _, c in q.rest()) for q in queues], np.int64)
    for configuration, times in _configurations(sizes, totals, capacity):
        for placed, sequences, length in _substituted(configuration, times, queues, used):
            ranges.extend(placed)
            rooms.setdefault(capacity - length, []).append((placed[0].sequence, sequences))
        used += times
    waiting = [run for queue in queues for run in queue.rest()]
    waiting += [(n, 0, c) for n, c in counts.items() if n < least and c]
    ranges.extend(_best_fit(sorted(waiting, reverse=True), rooms, used, capacity))
    return ranges, max((r.sequence + r.sequences for r in ranges), default=0)


def _grouped(counts: dict[int, int], groups: int) -> tuple[np.ndarray, list[_Queue]]:
    """Sizes, falling, and the documents that count as each: groups of equally many documents."""
    if not counts:
        return np.empty(0, np.int64), []
    per_group = -(-sum(counts.values()) // groups)
    by_size: dict[int, list[tuple[int, int, int]]] = {}
    size, room = 0, 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                size, room = length, per_group
            taken = min(left, room)
            by_size.setdefault(size, []).insert(0, (length, left - taken, taken))
            left, room = left - taken, room - taken
    return np.array(list(by_size), np.int64), [_Queue(runs) for runs in by_size.values()]


def _configurations(
    sizes: np.ndarray, totals: np.ndarray, capacity: int
) -> Iterator[tuple[np.ndarray, int]]:
    """(places per size, whole number of sequences) by column generation; never more places than documents.

    The basis starts with one size per configuration. A new column is the best filling of a sequence at the
    prices of the present basis, and the loop ends when no filling is worth more than a sequence.
    """
    if not len(sizes):
        return
    basis = np.diag(capacity // sizes).astype(float)
    for _ in range(60 * len(sizes)):
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        column = _best_filling(sizes, prices, capacity)
        if column @ prices <= 1 + 1e-7:
            break
        amounts = np.linalg.solve(basis, totals.astype(float))
        change = np.linalg.solve(basis, column.astype(float))
        steps = np.full(len(sizes), np.inf)
        np.divide(np.maximum(amounts, 0), change, out=steps, where=change > 1e-9)
        basis[:, int(np.argmin(steps))] = column
    amounts = np.linalg.solve(basis, totals.astype(float))
    left = totals.copy()
    for number in np.argsort(-amounts, kind="stable"):
        configuration = np.rint(basis[:, number]).astype(np.int64)
        used = configuration > 0
        times = min(int(amounts[number] + 1e-6), int((left[used] // configuration[used]).min()))
        if times > 0:
            left -= times * configuration
            yield configuration, times


def _best_filling(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """How often each size stands in the filling of greatest price (sizes may repeat)."""
    best = np.zeros(capacity + 1)
    choices = np.zeros((len(sizes), capacity + 1), np.int64)
    for j, (size, price) in enumerate(zip(sizes, prices)):
        if price <= 0:
            continue
        base = best.copy()
        for copies in range(1, capacity // size + 1):
            worth = base[: capacity + 1 - copies * size] + copies * price
            better = worth > best[copies * size :] + 1e-12
            best[copies * size :][better] = worth[better]
            choices[j, copies * size :][better] = copies
    filling, room = np.zeros(len(sizes), np.int64), capacity
    for j in range(len(sizes) - 1, -1, -1):
        filling[j] = choices[j, room]
        room -= filling[j] * sizes[j]
    return filling


def _substituted(
    configuration: np.ndarray, times: int, queues: list[_Queue], sequence: int
) -> Iterator[tuple[list[Range], int, int]]:
    """(ranges of one stretch of sequences with the same lengths, how many sequences, their filling)."""
    places = [queues[j].take(times) for j in np.repeat(np.arange(len(queues)), configuration)]
    cuts = {0}
    for runs in places:
        cuts.update(np.cumsum([count for _, _, count in runs]).tolist())
    positions = [[*runs] for runs in places]
    borders = sorted(cuts)
    for start, end in zip(borders, borders[1:]):
        placed, offset, n = [], 0, end - start
        for runs in positions:
            length, rank, count = runs[0]
            placed.append(Range(length, rank, 1, n, sequence + start, offset))
            offset += length
            if count == n:
                runs.pop(0)
            else:
                runs[0] = (length, rank + n, count - n)
        yield placed, n, offset


def _best_fit(
    waiting: list[tuple[int, int, int]],
    rooms: dict[int, list[tuple[int, int]]],
    sequence: int,
    capacity: int,
) -> Iterator[Range]:
    """Each run of equal lengths, longest first, into the sequences with the least sufficient room.

    A sequence that takes one document and has room for another of that length is then the tightest, so
    it takes as many as fit; that is done for all sequences of a stretch at once.
    """
    sequences = np.zeros(capacity + 1, np.int64)
    for room, stretches in rooms.items():
        sequences[room] = len(stretches)

    def put_back(room: int, first: int, n: int) -> None:
        rooms.setdefault(room, []).append((first, n))
        sequences[room] += 1

    for length, rank, count in waiting:
        while count:
            fitting = np.flatnonzero(sequences[length:])
            if len(fitting):
                room = length + int(fitting[0])
                first, n = rooms[room].pop()
                sequences[room] -= 1
            else:
                room = capacity
                each = room // length
                first, n = sequence, -(-count // each)
                sequence += n
            each = min(room // length, count)
            taken = min(n, count // each)
            yield Range(length, rank, each, taken, first, capacity - room)
            rank, count = rank + each * taken, count - each * taken
            put_back(room - each * length, first, taken)
            if taken < n:
                put_back(room, first + taken, n - taken)
