"""Row filters and quality rules.

Missing values are NULL. A comparison with a missing value is false, so each rule below states
whether such a row stays.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from powerflow.functions.times import utc_literal
from powerflow.operators.grouping import anti_join, as_list, batch_max, with_group_values
from powerflow.schemas import CONTRACT


def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def assert_contract(df: DataFrame, cols: Sequence[str] = CONTRACT) -> DataFrame:
    """The frame itself, provided the required columns exist."""
    missing = [name for name in cols if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def flag_columns(generation: str, capacity: str) -> dict[str, Column]:
    """Aggregates of an area.

    ``no_capacity``: the capacities add up to zero, missing ones counting as zero.
    ``no_generation``: every generation value is missing.
    """
    return {
        "no_capacity": F.coalesce(F.sum(capacity), F.lit(0.0)) == 0,
        "no_generation": F.count(generation) == 0,
    }


def partition_flags(
    df: DataFrame, key: str | Sequence[str], generation: str, capacity: str
) -> DataFrame:
    """The flags of its area on every row."""
    return with_group_values(df, key, flag_columns(generation, capacity))


def zero_gen_when_no_capacity(
    df: DataFrame,
    key: str | Sequence[str],
    generation: str = "generation_mw",
    capacity: str = "capacity_mwp",
) -> DataFrame:
    """Set the generation of an area without any capacity to zero."""
    flagged = partition_flags(df, key, generation, capacity)
    zeroed = F.when(F.col("no_capacity"), F.lit(0.0)).otherwise(F.col(generation))
    return flagged.withColumn(generation, zeroed).drop("no_capacity", "no_generation")


def drop_null_unless_all_null(
    df: DataFrame, key: str | Sequence[str], value: str = "generation_mw"
) -> DataFrame:
    """Drop missing generation, except in areas where every value is missing."""
    counted = with_group_values(df, key, {"_known": F.count(value)})
    return counted.filter(F.col(value).isNotNull() | (F.col("_known") == 0)).drop("_known")


def apply_area_flags(flagged: DataFrame, generation: str = "generation_mw") -> DataFrame:
    """Zero rule and missing-value rule on rows that carry the flags of ``partition_flags``."""
    value = F.when(F.col("no_capacity"), F.lit(0.0)).otherwise(F.col(generation))
    return (
        flagged.withColumn(generation, value)
        .filter(F.col(generation).isNotNull() | F.col("no_generation"))
        .drop("no_capacity", "no_generation")
    )


def settle_areas(
    df: DataFrame,
    key: str | Sequence[str],
    generation: str = "generation_mw",
    capacity: str = "capacity_mwp",
) -> DataFrame:
    """Zero rule followed by the missing-value rule, sharing one aggregate.

    An area without capacity has no missing generation left after the zero rule, so both flags can
    be taken from the raw rows.
    """
    return apply_area_flags(partition_flags(df, key, generation, capacity), generation)


def trim_unsettled(
    df: DataFrame,
    batch_keys: Sequence[str],
    validto: str = "validto",
    lastupdate: str = "lastupdate",
    lag: str = "15 minutes",
) -> DataFrame:
    """Keep rows that ended more than ``lag`` before the latest update of their batch."""
    limit = F.col("_latest") - F.expr(f"INTERVAL {lag}")
    return batch_max(df, batch_keys, lastupdate, "_latest").filter(F.col(validto) < limit).drop(
        "_latest"
    )


def drop_negative_power(df: DataFrame, col: str = "solar_generation_kw") -> DataFrame:
    """Drop negative power; a missing value stays."""
    return df.filter(F.col(col).isNull() | (F.col(col) >= 0))


def drop_zero_capacity(df: DataFrame, col: str = "capacity_kw") -> DataFrame:
    """Drop zero capacity; a missing capacity stays."""
    return df.filter(F.col(col).isNull() | (F.col(col) != 0))


def drop_over_capacity(
    df: DataFrame,
    generation: str = "solar_generation_kw",
    capacity: str = "capacity_kw",
    limit: float = 1.09,
) -> DataFrame:
    """Drop generation above the limit; equality and a missing capacity pass."""
    over = F.col(generation) > F.col(capacity) * F.lit(limit)
    return df.filter(~F.coalesce(over, F.lit(False)))


def flag_small_percentage(
    df: DataFrame, col: str = "percentage", threshold: float = 0.01
) -> DataFrame:
    """``update_capacity`` is false where the capacity in use is too small to derive a total."""
    small = F.col(col) < F.lit(threshold)
    return df.withColumn("update_capacity", ~F.coalesce(small, F.lit(False)))


def flag_stale(
    df: DataFrame, now: datetime | str, age: str, only: Column, ts: str = "target_datetime_utc"
) -> DataFrame:
    """Mark rows of one kind that are older than ``age``; all rows stay."""
    old = F.col(ts) < utc_literal(now) - F.expr(f"INTERVAL {age}")
    return df.withColumn("is_stale", F.coalesce(only & old, F.lit(False)))


def reject_null_prices(prices: DataFrame, price: str) -> DataFrame:
    """The price set, or no rows when any of its prices is missing."""
    incomplete = prices.agg(F.bool_or(F.col(price).isNull())).scalar()
    return prices.filter(~F.coalesce(incomplete, F.lit(False)))


def duplicate_timestamps(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*as_list(keys)).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def daily_grid(
    ids: DataFrame, start: datetime | str, end: datetime | str, step: str, ts: str
) -> DataFrame:
    """Every step of [start, end] for every id.

    Steps are generated per day, so no row ever carries the whole range; the step divides a day.
    """
    first, last = utc_literal(start), utc_literal(end)
    days = F.sequence(
        F.date_trunc("day", first).cast("timestamp_ntz"), last, F.expr("INTERVAL 1 DAY")
    )
    one_day = F.expr("INTERVAL 1 DAY")
    inside = F.sequence(F.col("_day"), F.col("_day") + one_day, F.expr(f"INTERVAL {step}"))
    return (
        ids.withColumn("_day", F.explode(days))
        .withColumn(ts, F.explode(inside))
        .filter((F.col(ts) < F.col("_day") + one_day) & F.col(ts).between(first, last))
        .drop("_day")
    )


def grid_completeness(
    df: DataFrame,
    ids: DataFrame,
    start: datetime | str,
    end: datetime | str,
    step: str,
    ts: str = "target_datetime_utc",
) -> DataFrame:
    """Expected (id, time) cells, both ends included, that the facts do not have."""
    keys = [*ids.columns, ts]
    cells = df.select(*ids.columns, F.col(ts).cast("timestamp_ntz").alias(ts))
    return anti_join(daily_grid(ids, start, end, step, ts), cells, keys)
