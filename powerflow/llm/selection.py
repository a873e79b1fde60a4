"""The exact k-th key of a table by a weighted median of medians, and the rows up to it in order.

Keys are three numbers in ascending order, the last of them unique. Each round cuts what remains into blocks,
takes every block's median and, of these, the median weighted by the blocks' sizes. At least a quarter of the
remaining rows lie on either side of it, so a round discards a guaranteed fraction. Counting both sides tells which
one holds the wanted key; the blocks' medians of either side come with the counts, so a round is one pass. What
remains is written anew whenever it has shrunk to an eighth, so all rounds together read little more than the
first. The rest is decided by one task as soon as a single block holds it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from powerflow.session import config_table, shared_table, written

BLOCK_ROWS = 1 << 16
SHRUNK = 8

Key = tuple[int, int, int]
_SIDES = ("low", "high")
_ROUND = ", ".join(f"{side}_n long, {side}_0 long, {side}_1 long, {side}_2 long" for side in _SIDES)


def _below(keys: list[np.ndarray], pivot: Key) -> np.ndarray:
    """Whether each key comes before the pivot."""
    a, b, c = keys
    x, y, z = pivot
    return (a < x) | (a == x) & ((b < y) | (b == y) & (c < z))


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[list[np.ndarray]]:
    """Keys of at most ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - n)
            held.append(part)
            n, batch = n + part.num_rows, batch.slice(part.num_rows)
            if n == rows:
                yield [np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(3)]
                held, n = [], 0
    if held:
        yield [np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(3)]


def _median(keys: list[np.ndarray]) -> tuple[int, ...]:
    """Number of keys and the middle one."""
    n = len(keys[0])
    if not n:
        return 0, 0, 0, 0
    middle = np.lexsort(keys[::-1])[(n - 1) // 2]
    return n, *(int(part[middle]) for part in keys)


def _round(pivot: Key | None, block_rows: int):
    """Counts and medians of either side of the pivot for each block; without one all rows are on the high side."""

    def medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys in _blocks(batches, block_rows):
            low = np.zeros(len(keys[0]), dtype=bool) if pivot is None else _below(keys, pivot)
            high = ~low
            if pivot is not None:
                high &= keys[2] != pivot[2]
            values = [*_median([k[low] for k in keys]), *_median([k[high] for k in keys])]
            names = [field.split()[0] for field in _ROUND.split(", ")]
            yield pa.RecordBatch.from_pydict({name: pa.array([v], pa.int64()) for name, v in zip(names, values, strict=True)})

    return medians


def _nth(k: int):
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys in _blocks(batches, 1 << 62):
            at = np.lexsort(keys[::-1])[k - 1]
            yield pa.RecordBatch.from_pydict({f"k{i}": keys[i][at : at + 1] for i in range(3)})

    return pick


def up_to(names: list[str], key: Key, within: bool = True) -> Column:
    """Whether a row's key comes before the given one or, with ``within``, is that one."""
    a, b, c = (F.col(name) for name in names)
    x, y, z = (F.lit(part).cast("long") for part in key)
    return (a < x) | (a == x) & ((b < y) | (b == y) & (c <= z if within else c < z))


def kth_key(df: DataFrame, names: list[str], k: int, block_rows: int = BLOCK_ROWS) -> Key:
    """The k-th smallest key, counted from 1, of a table that gives the same rows each time it is read.

    The driver receives a few numbers for each block of ``block_rows`` rows.
    """
    left = df.select(*[F.col(name).alias(f"k{i}") for i, name in enumerate(names)])
    bare = ["k0", "k1", "k2"]
    pivot: Key | None = None
    with ExitStack() as tables:
        stored = 0
        while True:
            rounds = left.mapInArrow(_round(pivot, block_rows), _ROUND).toArrow()
            columns = {name: rounds[name].to_numpy() for name in rounds.column_names}
            low, high = (int(columns[f"{side}_n"].sum()) for side in _SIDES)
            side = "high"
            if pivot is not None:
                if k == low + 1:
                    return pivot
                if k <= low:
                    side, left = "low", left.filter(up_to(bare, pivot, within=False))
                else:
                    k, left = k - low - 1, left.filter(~up_to(bare, pivot))
            rest = low if side == "low" else high
            if not 0 < k <= rest:
                raise ValueError(f"there is no key number {k} of {rest}")
            if rest <= block_rows:
                found = left.coalesce(1).mapInArrow(_nth(k), "k0 long, k1 long, k2 long").toArrow()
                return tuple(found[name][0].as_py() for name in bare)
            stored = stored or rest
            if rest * SHRUNK <= stored:
                left, stored = tables.enter_context(shared_table(left, "selection")), rest
            medians = [columns[f"{side}_{i}"] for i in range(3)]
            order = np.lexsort(medians[::-1])
            weight = np.cumsum(columns[f"{side}_n"][order])
            middle = order[np.searchsorted(weight, (rest + 1) // 2)]
            pivot = tuple(int(part[middle]) for part in medians)


def ranked(df: DataFrame, names: list[str], purpose: str) -> DataFrame:
    """Rows with their ``rank`` from 1 in the order of unique keys, sorted by ranges and not in one task."""
    order = [F.col(name) for name in names]
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # a row's partition in the upper bits and its place there in the lower 33
    placed = written(rows.withColumn("_place", F.monotonically_increasing_id()), purpose)
    part = F.shiftright("_place", 33)
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())
    before, starts = 0, []
    for number, size in sizes:
        starts.append({"_part": number, "_before": before})
        before += size
    offsets = config_table(df.sparkSession, starts, "_part long, _before long")
    numbered = placed.withColumn("_part", part).join(offsets, "_part")
    rank = F.col("_before") + F.col("_place").bitwiseAND((1 << 33) - 1) + 1
    return numbered.withColumn("rank", rank).drop("_part", "_place", "_before")
