"""Extents, distinct keys, summaries and grouped payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from powerflow.operators.grouping import as_list
from powerflow.session import written


def time_extent(
    df: DataFrame, ts: str, keys: str | Sequence[str] = (), updated: str | None = None
) -> DataFrame:
    """First and last timestamp, and the last update when there is such a column."""
    values = [F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")]
    if updated:
        values.append(F.max(updated).alias("last_update"))
    return df.groupBy(*as_list(keys)).agg(*values)


def distinct_keys(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Distinct keys with their number of rows."""
    return df.groupBy(*as_list(cols)).agg(F.count(F.lit(1)).alias("n_rows"))


def run_summary(
    df: DataFrame, keys: str | Sequence[str], ts: str, value: str
) -> DataFrame:
    """Rows, known values, total and extent per target of a run."""
    return df.groupBy(*as_list(keys)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(value).alias("n_values"),
        F.sum(value).alias("total"),
        F.count_distinct(ts).alias("n_timestamps"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
    )


def collect_observations(
    df: DataFrame,
    keys: Sequence[str] = ("location_uuid", "energy_source", "observer_name"),
    ts: str = "timestamp_utc",
    watts: str = "value_watts",
    max_values: int = 1000,
) -> DataFrame:
    """Payloads of time-ordered values (time, watts, copies) per location, source and observer.

    A location's history has no upper size, so a payload covers one hour, and an hour with more
    than ``max_values`` values, copies included, is spread over payloads of at most about that size
    (``part``).
    Identical values are one entry with its number of copies; they are counted before the shuffle,
    so a value repeated without end is no larger than any other.

    Hours that need several payloads are found first and written; they are few, and where Catalyst can
    broadcast them every row knows its payload before it moves. Values are then shuffled twice, counted
    and gathered, and never to learn the size of their hour.
    """
    slot = [*keys, "slot_start"]
    hour = F.date_trunc("hour", ts).cast(df.schema[ts].dataType)
    rows = df.select(*keys, hour.alias("slot_start"), F.col(ts).alias("_ts"), F.col(watts).alias("_watts"))
    sizes = rows.groupBy(*slot).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_values)
    names = {name: f"_large_{i}" for i, name in enumerate(slot)}
    large = written(sizes.withColumn("_hash", F.xxhash64(*slot)).withColumnsRenamed(names), "large-hours")
    same = F.col("_place") == F.col("_hash")
    for name, other in names.items():
        same = same & F.col(f"`{name}`").eqNullSafe(F.col(other))
    placed = rows.withColumn("_place", F.xxhash64(*slot)).join(large, same, "left")
    parts = F.ceil(F.col("_n") / max_values)
    part = F.when(parts.isNull(), 0).otherwise(F.pmod(F.xxhash64("_ts", "_watts"), parts)).cast("int")
    values = placed.groupBy(*slot, part.alias("part"), "_ts", "_watts").agg(F.count(F.lit(1)).alias("_copies"))
    entry = F.struct(
        F.col("_ts").alias("ts"), F.col("_watts").alias("watts"), F.col("_copies").alias("copies")
    )
    payload = F.sort_array(F.collect_list(entry)).alias("values")
    return values.groupBy(*slot, "part").agg(payload)
