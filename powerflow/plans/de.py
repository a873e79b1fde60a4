"""German generation per control area and the national forecasts.

Each area lands its own wide table, in MW and in the area's wall-clock time (``ts_local``).
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from powerflow.functions.naming import canonical_schema, lookup_map, tag_constants
from powerflow.functions.times import local_to_utc
from powerflow.functions.units import mw_to_kw
from powerflow.operators.capacity import latest_capacity
from powerflow.operators.grouping import newest_poll
from powerflow.operators.matching import union_feeds
from powerflow.operators.series import pick_landed_series, pick_series
from powerflow.settings import DE_AREAS, DE_PROCESS_TYPES, DE_TSO_NAMES
from powerflow.sources.landed import LANDED
from powerflow.sources.windows import feed_window, time_window

ZONE = "Europe/Berlin"
LOCAL = "ts_local"


def solar_series(wide: DataFrame) -> DataFrame:
    """Solar generation of one area in UTC and kW.

    ``wide`` is a table with one header, or lines that bring the header of their own file.
    """
    landed = [name for name in (LANDED,) if name in wide.columns]
    if "cells" in wide.columns:
        series = pick_landed_series(wide, [LOCAL], landed)
    else:
        series = pick_series(wide, [LOCAL, *landed])
    return series.select(
        local_to_utc(F.col(LOCAL), ZONE).cast("timestamp").alias("target_datetime_utc"),
        mw_to_kw(F.col("value")).alias("solar_generation_kw"),
        *landed,
    )


def newest_steps(series: DataFrame) -> DataFrame:
    return newest_poll(series, ["region", "target_datetime_utc"], [LANDED])


def de_generation(
    areas: Mapping[str, DataFrame],
    capacities: DataFrame,
    now: datetime | str,
    backfill_hours: float | None = None,
) -> DataFrame:
    """Generation of the areas that have landed, with their newest installed capacity.

    ``capacities`` has the columns region, year start and MW.
    """
    unknown = set(areas) - set(DE_AREAS)
    if unknown:
        raise ValueError(f"unknown areas: {sorted(unknown)}")
    start, end = feed_window("de_generation", now, backfill_hours)
    series = union_feeds(
        *[tag_constants(solar_series(areas[region]), region=region) for region in areas]
    )
    # one row per known area at most, so the size of the broadcast side has a fixed bound
    known = capacities.filter(F.col("region").isin(*DE_AREAS))
    installed = F.broadcast(latest_capacity(known, "region", "year_start"))
    inside = newest_steps(time_window(series, "target_datetime_utc", start, end))
    joined = inside.join(installed, "region", "left")
    named = joined.withColumn("tso_zone", lookup_map(F.col("region"), DE_TSO_NAMES))
    return canonical_schema(named, "de_generation")


def de_forecast(wide: DataFrame, kind: str, now: datetime | str) -> DataFrame:
    """National forecast of one kind for today and tomorrow."""
    if kind not in DE_PROCESS_TYPES:
        raise ValueError(f"unknown forecast {kind!r}, expected one of {list(DE_PROCESS_TYPES)}")
    start, end = feed_window("de_forecast", now)
    series = time_window(solar_series(wide), "target_datetime_utc", start, end)
    national = newest_steps(tag_constants(series, region="de", forecast_type=kind))
    return canonical_schema(national, "de_forecast")
