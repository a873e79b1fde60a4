"""Drawing documents so that their words follow a target's, by hashed n-gram weights.

Every run of words is a feature; its bucket is the CRC-32 of its bytes modulo the number of buckets. Counts of all
buckets over the documents and over the target give each bucket a gain, the logarithm of the ratio of its smoothed
shares. A document's weight is the mean gain of its features, and its score the weight plus a Gumbel number that its
id fixes; the highest scores are a sample without replacement in proportion to the weights' exponentials.

Counting adds up one array in every task, so each task shuffles at most one row a bucket. The gains, one number a
bucket, go to all workers, where whole batches are scored by numpy. The exact cutoff is found by
:func:`powerflow.llm.selection.kth_key`, and the drawn rows are numbered in a distributed sort.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from powerflow.llm.selection import kth_key, ranked, up_to
from powerflow.llm.words import PIECE_BYTES, pieces, word_ranges
from powerflow.session import written

BUCKETS = 10_000
MAX_BUCKETS = 1 << 20  # bounds the arrays that tasks add up and workers hold
SCALE = 1000
LONG_WORD = 64

KEY = ["_k0", "_k1", "_k2"]

_TABLE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _TABLE = np.where(_TABLE & 1, (_TABLE >> 1) ^ np.uint32(0xEDB88320), _TABLE >> 1)
_ONES = np.uint32(0xFFFFFFFF)


def crc_of_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """CRC-32 of each byte range, a byte of all ranges at a time; ``before`` holds those of what precedes them."""
    state = np.full(len(start), _ONES) if before is None else before ^ _ONES
    short = end - start <= LONG_WORD
    open_ = np.flatnonzero(short & (end > start))
    at, until = start[open_], end[open_]
    while len(open_):
        old = state[open_]
        state[open_] = _TABLE[(old ^ data[at]) & 255] ^ (old >> 8)
        at = at + 1
        more = at < until
        if not more.all():
            open_, at, until = open_[more], at[more], until[more]
    for i in np.flatnonzero(~short):
        state[i] = zlib.crc32(data[start[i] : end[i]].tobytes(), int(state[i] ^ _ONES)) ^ 0xFFFFFFFF
    return state ^ _ONES


def features(column: pa.Array, orders: tuple[int, int], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of each feature, and the words of each row."""
    data, start, end, first = word_ranges(column)
    n_words = np.diff(first)
    row = np.repeat(np.arange(len(column)), n_words)
    places = np.arange(len(start))
    crc, found, rows = None, [], []
    for n in range(1, orders[1] + 1):
        if n == 1:
            crc = crc_of_ranges(data, start, end)
        else:
            on = np.repeat(first[1:], n_words)[places] - places >= n  # the row has another word
            places = places[on]
            blank = _TABLE[(crc[on] ^ _ONES ^ 32) & 255] ^ ((crc[on] ^ _ONES) >> 8) ^ _ONES
            crc = crc_of_ranges(data, start[places + n - 1], end[places + n - 1], blank)
        if n >= orders[0]:
            found.append(crc % np.uint32(buckets))
            rows.append(row[places])
    return np.concatenate(found), np.concatenate(rows), n_words


def bucket_counts(df: DataFrame, orders: tuple[int, int], buckets: int, text_col: str = "text") -> np.ndarray:
    """Features of all texts in each bucket. Each task sends at most a row a bucket, the driver gets the sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for piece in pieces(batch, "text"):
                total += np.bincount(features(piece.column(0), orders, buckets)[0], minlength=buckets)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": full.astype(np.int32), "n": total[full]})

    texts = df.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    sums = texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, dtype=np.int64)
    counts[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share in the target over that in the source, floored."""
    buckets = len(source)
    whole, aim = float(source.sum()) + buckets, float(target.sum()) + buckets
    values = [
        math.floor(SCALE * math.log((float(t) + 1) * whole / ((float(s) + 1) * aim)))
        for s, t in zip(source.tolist(), target.tolist(), strict=True)
    ]
    return np.array(values, dtype=np.int64)


def weights(text: Column, gain: np.ndarray, orders: tuple[int, int]) -> Column:
    """Struct of ``n_words``, ``n_features`` and ``weight``; NULL and texts without features weigh 0."""
    buckets = len(gain)

    @F.arrow_udf("n_words long, n_features long, weight long")
    def weigh(column: pa.Array) -> pa.Array:
        parts = []
        batch = pa.RecordBatch.from_arrays([column], ["text"])
        for piece in pieces(batch, "text", PIECE_BYTES):
            bucket, row, n_words = features(piece.column(0), orders, buckets)
            n = np.bincount(row, minlength=piece.num_rows)
            # sums of whole numbers below 2^53 are exact in doubles
            total = np.bincount(row, weights=gain[bucket], minlength=piece.num_rows).astype(np.int64)
            parts.append((n_words, n, np.where(n > 0, total // np.maximum(n, 1), 0)))
        columns = [np.concatenate(part) if parts else np.zeros(0) for part in zip(*parts, strict=True)] or [np.zeros(0)] * 3
        names = ["n_words", "n_features", "weight"]
        return pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)

    return weigh(F.coalesce(text.cast("string"), F.lit("")))


def gumbel(id_col: Column, seed: int) -> Column:
    """Thousandths of a Gumbel number that seed and id fix, floored; a NULL id counts as the empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.left(F.sha2(name, 256), F.lit(8)), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0)))


def draw(
    documents: DataFrame, target: DataFrame, percent: int, min_words: int, seed: int,
    orders: tuple[int, int] = (1, 1), buckets: int = BUCKETS,
    id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", keep_rows: bool = False,
) -> DataFrame:
    """Every document's ``id``, ``n_words``, ``n_features``, ``weight``, ``score`` and, if drawn, ``rank``.

    Of the documents with at least ``min_words`` words the given percentage, rounded down, is drawn: the highest
    scores, ties to the smaller id, which must be a whole number; NULL is the smallest. Rows equal in both are
    distinct documents in no particular order. NULL texts have no words. Empty tables give no rows; an empty target
    only smooths. With ``keep_rows`` the documents come along whole as the struct column ``row``.
    """
    if not 0 < buckets <= MAX_BUCKETS:
        raise ValueError(f"the number of buckets must be at most {MAX_BUCKETS}")
    source = bucket_counts(documents, orders, buckets, text_col)
    gain = gains(source, bucket_counts(target, orders, buckets, target_text))
    own = F.col(f"`{id_col}`")
    rows = [F.struct("*").alias("row")] if keep_rows else []
    weighed = documents.select(*rows, own.alias("id"), weights(F.col(f"`{text_col}`"), gain, orders).alias("_w"))
    scored = weighed.select(
        *[F.col("row")] * keep_rows, "id", "_w.*", (F.col("_w.weight") + gumbel(F.col("id"), seed)).alias("score")
    )
    smallest = F.lit(-(1 << 63)).cast("long")
    scored = written(scored.withColumns({
        KEY[0]: -F.col("score"), KEY[1]: F.coalesce(F.col("id").cast("long"), smallest),
        KEY[2]: F.monotonically_increasing_id(),
    }), "importance")
    eligible = F.col("n_words") >= min_words
    wanted = scored.filter(eligible).count() * percent // 100
    none = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scored.select("*", none).drop(*KEY)
    winner = eligible & up_to(KEY, kth_key(scored.filter(eligible), KEY, wanted))
    drawn = ranked(scored.filter(winner), KEY, "importance-drawn")
    return drawn.unionByName(scored.filter(~winner).withColumn("rank", none)).drop(*KEY)


def resample(documents: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents with all their columns, by their place in the draw."""
    drawn = draw(documents, target, keep_rows=True, **options).filter(F.col("rank").isNotNull())
    return drawn.select("row.*", F.col("rank").alias("draw_rank"))
