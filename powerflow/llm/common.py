"""Reading of the given tables and keys shared by the operators."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Rows are handed to Python in batches of about this size, or of one row; by default their number alone counts.
BATCH_BYTES = 1 << 22


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table by a path that only Spark needs to understand, for tasks that hold few of its texts at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Key, id and whole text; further columns of any name are left out.

    ``text_key`` stands for the text in keys. Rows equal in both are one document that occurs
    several times, so no row number is needed, which a recomputed task could change.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return df.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), text_key(text).alias("text_key"))


def text_key(text: Column) -> Column:
    """128 bits of a text: two hashes with different beginnings."""
    halves = (F.xxhash64(text), F.xxhash64(F.lit(1), text))
    return F.concat(*[F.unhex(F.lpad(F.hex(half), 16, "0")) for half in halves])


def _row_key(id_col: str, text_col: str) -> Column:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return F.struct(F.col(f"`{id_col}`").alias("id"), text_key(text).alias("text_key"))


def without_documents(
    documents: DataFrame, listed: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows whose ``id`` and ``text_key`` are not listed; columns of any name stay as they are."""
    own = _row_key(id_col, text_col)
    rows = documents.select(F.struct("*").alias("row"), F.xxhash64(own).alias("place"), own.alias("own"))
    listed = listed.select(F.struct("id", "text_key").alias("other"))
    listed = listed.select("other", F.xxhash64("other").alias("other_place"))
    same = (F.col("place") == F.col("other_place")) & F.col("own").eqNullSafe(F.col("other"))
    return rows.join(listed, same, "left_anti").select("row.*")


def keep_marked(
    documents: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows that ``found`` marks as ``kept``, one of each, all columns as they are.

    ``found`` has a row for each row of the documents, with ``id``, ``text_key``, ``kept`` and ``copy``,
    the number among rows equal in id and text.
    """
    dropped = found.groupBy("id", "text_key").agg(F.bool_or("kept").alias("kept"), F.max("copy").alias("copies"))
    left = without_documents(documents, dropped.filter("NOT kept").select("id", "text_key"), id_col, text_col)
    if dropped.filter("kept AND copies > 1").isEmpty():
        return left
    rows = left.select(F.struct("*").alias("row"), _row_key(id_col, text_col).alias("own"))
    return rows.dropDuplicates(["own"]).select("row.*")


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def crc_part(id_col: Column, parts: int) -> Column:
    """Remainder of the CRC-32 of the id as text; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % parts


def release_memory() -> None:
    """Give what a task no longer needs back to the system; the worker stays for other work."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
