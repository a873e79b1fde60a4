"""Words and shingles of whole Arrow batches as 64-bit hashes.

The operators on words would spend most of their time in per-word Python; here a batch is handled by
a fixed number of numpy calls. Texts are cut at whole rows into pieces of bounded size, so memory
follows the longest text and not the batch.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# letters and digits of ASCII and every byte of a longer UTF-8 sequence
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
# everything but blanks
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[32, *range(9, 14)]] = False

_LONG_WORD = 256
_MASKS = np.array([0] + [(1 << (8 * n)) - 1 for n in range(1, 9)], dtype=np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@dataclass
class Words:
    """Words of some rows: byte ranges in ``data``, their hashes, and each row's first word."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # one more than the rows

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def texts(self, begin: int, end: int) -> list[str]:
        """Lower-cased words of an index range."""
        return [
            self.data[a:b].tobytes().decode("utf-8", "replace")
            for a, b in zip(self.start[begin:end], self.end[begin:end], strict=True)
        ]


def pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with at most ``limit`` bytes of text, or one longer row."""
    sizes = batch.column(text)
    lengths = np.asarray(pc.binary_length(sizes).fill_null(0).to_numpy(zero_copy_only=False))
    begin, held = 0, 0
    for i, length in enumerate(lengths):
        if i > begin and held + length > limit:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += int(length)
    if begin < len(lengths):
        yield batch.slice(begin)


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other and the rows' offsets; NULL is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split_words(column: pa.Array, classes: np.ndarray = ALPHANUMERIC, lower: bool = True) -> Words:
    """Words of each row: runs of bytes of one class other than zero. A-Z is lower-cased first."""
    data, start, end, first = word_ranges(column, classes, lower)
    return Words(data, start, end, hash_ranges(data, start, end), first)


def word_ranges(
    column: pa.Array, classes: np.ndarray = ALPHANUMERIC, lower: bool = True
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, begins and ends of words, and each row's first word."""
    data, offsets = raw_bytes(column)
    if lower:
        data = _LOWER[data]
    kind = classes[data]
    changes = np.ones(len(kind) + 1, dtype=bool)
    if len(kind):
        np.not_equal(kind[1:], kind[:-1], out=changes[1:-1])
        changes[offsets] = True
    inside = kind != 0
    start = np.flatnonzero(changes[:-1] & inside)
    end = np.flatnonzero(changes[1:] & inside) + 1
    return data, start, end, np.searchsorted(start, offsets)


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, eight bytes at a time over all ranges at once."""
    length = end - start
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    lanes = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    value = mix(length.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    left = np.minimum(length, _LONG_WORD)
    open_ = np.arange(len(start))
    at = start.copy()
    while len(open_):
        lane = lanes[at] & _MASKS[np.minimum(left, 8)]
        value[open_] = mix(value[open_] * np.uint64(0x9E3779B97F4A7C15) + lane)
        more = left > 8
        open_, at, left = open_[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(length > _LONG_WORD):
        rest = data[start[i] : end[i]].tobytes()
        extra = zlib.crc32(rest) << 32 | zlib.crc32(rest[::-1])
        value[i] = mix(value[i : i + 1] ^ np.uint64(extra))[0]
    return value


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words and the index of each shingle's first word.

    A row with fewer words, but not none, has one shingle of all of them.
    """
    counts, hashes = words.counts, words.hash
    total = len(hashes)
    room = np.repeat(words.first[1:], counts) - np.arange(total)  # words from here to the row's end
    begin = np.flatnonzero(room >= size)
    value = np.full(len(begin), size, dtype=np.uint64)
    for j in range(size):
        value = value * np.uint64(0x9E3779B97F4A7C15) + hashes[begin + j]
        value ^= value >> np.uint64(29)
    value = mix(value)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if not len(short):
        return value, begin
    first, n = words.first[short], counts[short]
    extra = n.astype(np.uint64)
    for j in range(size - 1):
        on = n > j
        step = extra[on] * np.uint64(0x9E3779B97F4A7C15) + hashes[first[on] + j]
        extra[on] = step ^ (step >> np.uint64(29))
    value = np.concatenate([value, mix(extra)])
    begin = np.concatenate([begin, first])
    order = np.argsort(begin, kind="stable")
    return value[order], begin[order]
