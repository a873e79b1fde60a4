"""Capacity: seeds, defaults, validation and changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from powerflow.functions.units import kw_to_watts
from powerflow.operators.grouping import (
    columns_of,
    fact_join,
    first_per_key,
    latest_per_location,
    with_group_values,
)

BITS = 62


def seed_capacity(
    df: DataFrame,
    key: str,
    generation: str = "solar_generation_kw",
    capacity: str = "capacity_kw",
) -> DataFrame:
    """Watts to start a new location with: largest capacity, else largest generation.

    Keys with neither are left out.
    """
    best = F.max(generation)
    if capacity in df.columns:
        best = F.coalesce(F.max(capacity), best)
    seeds = df.groupBy(key).agg(kw_to_watts(best).alias("seed_watts"))
    return seeds.filter(F.col(key).isNotNull() & F.col("seed_watts").isNotNull())


def capacity_override(df: DataFrame, site_key: str, capacity: str = "capacity_kw") -> DataFrame:
    """Largest capacity per site as a whole number of kW; NULL when all are missing."""
    return df.groupBy(site_key).agg(F.max(capacity).cast("bigint").alias("capacity_override_kw"))


def max_generation_default(
    df: DataFrame,
    key: str | None = None,
    generation: str = "solar_generation_kw",
    capacity: str = "capacity_kw",
) -> DataFrame:
    """Capacity for a feed without one: largest generation of the key, or of the whole batch."""
    if capacity in df.columns:
        return df
    if key is not None:
        return with_group_values(df, key, {capacity: F.max(generation)})
    return df.withColumn(capacity, df.agg(F.max(generation)).scalar())


def latest_capacity(df: DataFrame, key: str, ts: str, value: str | None = None) -> DataFrame:
    """Newest known capacity per area, MW to kW.

    The value is the "Solar" column or, without one, the first column that is neither key nor time.
    """
    if value is None:
        others = [name for name in df.columns if name not in (key, ts)]
        value = "Solar" if "Solar" in others else others[0]
    known = df.filter(F.col(value).isNotNull())
    newest = F.max_by(F.col(value), F.col(ts)) * F.lit(1000)
    return known.groupBy(key).agg(newest.alias("capacity_kw"))


def _each_exactly_once(col: Column, expected: Sequence[int]) -> Column:
    """Aggregate: the group holds every expected id once and nothing else.

    Presence is kept as bits, so no distinct aggregate (and no second shuffle) is needed.
    """
    complete = F.count(F.lit(1)) == len(expected)
    for start in range(0, len(expected), BITS):
        block = expected[start : start + BITS]
        bits = F.lit(0).cast("bigint")
        for place, value in reversed(list(enumerate(block))):
            bits = F.when(col == value, F.lit(1 << place).cast("bigint")).otherwise(bits)
        complete = complete & (F.bit_or(bits) == F.lit((1 << len(block)) - 1))
    return F.coalesce(complete, F.lit(False))


def region_set_complete(
    df: DataFrame,
    expected_ids: Sequence[int],
    ts: str = "target_datetime_utc",
    region: str = "region_id",
    value: str = "capacity_kw",
) -> DataFrame:
    """Per timestamp: are the rows with a value exactly one of each expected region?"""
    known = df.filter(F.col(region).isNotNull() & F.col(value).isNotNull())
    complete = _each_exactly_once(F.col(region), expected_ids)
    return known.groupBy(ts).agg(complete.alias("is_complete"))


def complete_timestamps(df: DataFrame, expected_ids: Sequence[int], **names) -> DataFrame:
    """Rows of timestamps with a complete set of regions."""
    ts = names.get("ts", "target_datetime_utc")
    complete = region_set_complete(df, expected_ids, **names).filter("is_complete")
    return fact_join(df, complete, ts, "left_semi")


def regional_sum(
    df: DataFrame,
    national_id: int = 0,
    ts: str = "target_datetime_utc",
    region: str = "region_id",
    value: str = "capacity_kw",
) -> DataFrame:
    """Per timestamp: sum over the regions and the national value."""
    return df.groupBy(ts).agg(
        F.sum(F.when(F.col(region) != national_id, F.col(value))).alias("regional"),
        F.max(F.when(F.col(region) == national_id, F.col(value))).alias("national"),
    )


def _is_close(regional: Column, national: Column, rtol: float) -> Column:
    gap = F.abs(regional - national)
    return F.coalesce(gap <= F.lit(rtol) * F.abs(national), F.lit(False))


def national_vs_regional(
    df: DataFrame, rtol: float = 0.001, national_id: int = 0, **names
) -> DataFrame:
    """Per timestamp: does the regional sum agree with the national value?"""
    close = _is_close(F.col("regional"), F.col("national"), rtol)
    return regional_sum(df, national_id, **names).withColumn("is_close", close)


def validate_capacity(
    df: DataFrame,
    expected_ids: Sequence[int],
    rtol: float = 0.001,
    national_id: int = 0,
    ts: str = "target_datetime_utc",
    region: str = "region_id",
    value: str = "capacity_kw",
) -> DataFrame:
    """Withdraw ``update_capacity`` where a timestamp is incomplete or does not add up.

    A missing capacity makes its timestamp incomplete. Both tests come from one aggregate per
    timestamp, whose result is joined back.
    """
    known = df.filter(F.col(region).isNotNull() & F.col(value).isNotNull())
    regional = F.sum(F.when(F.col(region) != national_id, F.col(value)))
    national = F.max(F.when(F.col(region) == national_id, F.col(value)))
    trusted = _each_exactly_once(F.col(region), expected_ids) & _is_close(regional, national, rtol)
    verdicts = known.groupBy(ts).agg(trusted.alias("_trusted"))
    flag = F.col("update_capacity") if "update_capacity" in df.columns else F.lit(True)
    checked = fact_join(df, verdicts, ts, "left").select(*columns_of(df), "_trusted")
    return checked.withColumn(
        "update_capacity",
        F.coalesce(flag, F.lit(True)) & F.coalesce(F.col("_trusted"), F.lit(False)),
    ).drop("_trusted")


def capacity_updates(
    df: DataFrame,
    min_delta: float = 1.0,
    join_key: str = "join_key",
    location: str = "location_uuid",
    ts: str = "target_datetime_utc",
    current: str = "effective_capacity_watts",
    new: str = "new_effective_capacity_watts",
) -> DataFrame:
    """Newest row per location whose capacity moved by at least ``min_delta`` watts.

    Rows without a new capacity or with ``update_capacity`` false are not considered. Of several
    locations with one join key the newest wins. Equal times go to the larger capacity.
    """
    rows = df.filter(F.col(new).isNotNull())
    if "update_capacity" in df.columns:
        rows = rows.filter("update_capacity")
    larger = F.col(new).desc()
    newest = latest_per_location(rows, location, ts, [larger])
    moved = newest.filter(F.abs(F.col(current) - F.col(new)) >= min_delta)
    if join_key not in df.columns:
        return moved
    return first_per_key(moved, join_key, [F.col(ts).desc(), larger, F.col(location)])
