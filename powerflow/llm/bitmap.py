"""A set of 64-bit hashes as a bitmap of fixed size.

The bitmap is broadcast, whatever the set's size: more members only let more other values pass. What passes
is joined afterwards, so a bitmap changes costs and never results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 25  # 4 MB


def bitmap_of(hashes: DataFrame, column: str) -> Broadcast:
    """Bitmap over the hashes, put together by Spark; 2^FILTER_BITS / 64 numbers at most."""
    slot = f"shiftrightunsigned(`{column}`, {64 - FILTER_BITS})"
    words = (
        hashes.filter(F.col(column).isNotNull())
        .groupBy(F.expr(f"cast(shiftright({slot}, 6) as int)").alias("word"))
        .agg(F.expr(f"bit_or(shiftleft(1L, cast({slot} % 64 as int)))").alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(1 << (FILTER_BITS - 6), dtype="<i8")
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy()
    return hashes.sparkSession.sparkContext.broadcast(bitmap.view(np.uint8))


def passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def may_be_in(hashes: Column, bitmap: Broadcast) -> Column:
    @F.arrow_udf("boolean")
    def test(column: pa.Array) -> pa.Array:
        return pa.array(passes(bitmap.value, column.fill_null(0).to_numpy(zero_copy_only=False)))

    return test(hashes)
