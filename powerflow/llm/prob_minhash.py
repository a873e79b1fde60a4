"""ProbMinHash signatures of weighted shingle sets, vectorised over many documents.

Every element is a Poisson process whose rate is its weight. Its arrivals, taken in order, fall into
registers, and a register keeps the element of its earliest arrival. Two sets agree in a register with
a probability equal to their probability Jaccard similarity, which for equal weights is the Jaccard
similarity. An element whose next arrival is later than the latest register can change nothing any more and stops.
"""

from __future__ import annotations

import numpy as np

from powerflow.llm.words import mix

REGISTERS = 256  # a power of two: a register is chosen by bits
ROWS = 6  # registers in a band
BANDS = 42

_STEP = np.uint64(0x9E3779B97F4A7C15)
_REGISTER_BITS = np.uint64(REGISTERS - 1)


def signatures(elements: np.ndarray, weights: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Signature of each of ``rows`` sets: the element kept in each register, zeros for an empty set.

    ``row`` tells the set of each element and is sorted; elements of a set are distinct.
    """
    earliest = np.full(rows * REGISTERS, np.inf)
    kept = np.zeros(rows * REGISTERS, dtype=np.uint64)
    active = np.arange(len(elements))
    now = np.zeros(len(elements))
    done, block = 0, 1
    while len(active):
        own = elements[active]
        steps = np.arange(done + 1, done + block + 1, dtype=np.uint64) * _STEP
        bits = mix(own[:, None] + steps[None, :])
        waits = -np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        arrivals = now[active, None] + np.cumsum(waits / weights[active, None], axis=1)
        slots = (row[active] * REGISTERS)[:, None] + (bits & _REGISTER_BITS).astype(np.int64)
        arrivals_flat, slots = arrivals.ravel(), slots.ravel()
        sooner = np.flatnonzero(arrivals_flat < earliest[slots])
        slots, times = slots[sooner], arrivals_flat[sooner]
        np.minimum.at(earliest, slots, times)
        won = np.flatnonzero(times == earliest[slots])
        kept[slots[won]] = own[sooner[won] // block]
        now[active] = arrivals[:, -1]
        latest = earliest.reshape(rows, REGISTERS).max(axis=1)
        active = active[now[active] < latest[row[active]]]
        done += block
        block = min(2 * block, 256)
    return kept.reshape(rows, REGISTERS)


def bands_of(signature: np.ndarray) -> np.ndarray:
    """Hash of each band of each signature; the band's number is part of it."""
    value = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * _STEP
    value = np.repeat(value, len(signature), axis=0)
    used = signature[:, : ROWS * BANDS].reshape(len(signature), BANDS, ROWS)
    for j in range(ROWS):
        value = mix(value + used[:, :, j] * _STEP)
    return value


def weighted_sets(hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements of each row with their counts: (elements, counts, row), sorted by row."""
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    counts = np.diff(np.append(begin, len(hashes)))
    return hashes[begin], counts.astype(np.float64), row[begin]


def jaccard(left: np.ndarray, right: np.ndarray) -> float:
    """Jaccard similarity of two sorted arrays of distinct elements."""
    if not len(left) or not len(right):
        return 0.0
    common = len(np.intersect1d(left, right, assume_unique=True))
    return common / (len(left) + len(right) - common)
