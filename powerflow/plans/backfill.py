"""Historical cubes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from powerflow.functions.units import cast_float32
from powerflow.operators.grouping import fact_join
from powerflow.operators.cubes import cube_columns, pivot_cube
from powerflow.operators.matching import registry_equality
from powerflow.operators.quality import duplicate_timestamps, grid_completeness
from powerflow.sources.windows import time_window

CUBE_VALUES = ("generation_mw", "capacity_mwp")


def backfill_regional_cube(
    df: DataFrame,
    start: datetime | str,
    end: datetime | str,
    ids: Sequence[str],
    generation: str = "measured",
) -> DataFrame:
    """Landed regional history in [start, end) as a 32-bit time by location table.

    The landed columns are datetime, region, the generation column and monitoredcapacity. A region that
    is not in ``ids`` is an error, as the cube would not show it.
    """
    renamed = df.select(
        F.col("datetime").alias("time_utc"),
        F.col("region").alias("location_name"),
        F.col(generation).alias("generation_mw"),
        F.col("monitoredcapacity").alias("capacity_mwp"),
    )
    inside = time_window(renamed, "time_utc", start, end, closed="left")
    unknown = inside.filter(~F.coalesce(F.col("location_name").isin(list(ids)), F.lit(False)))
    _refuse(unknown.select("location_name").distinct(), "regions that are not in the list")
    cube = pivot_cube(inside, "time_utc", "location_name", CUBE_VALUES, ids)
    return cast_float32(cube, cube_columns(ids, CUBE_VALUES))


def _refuse(problems: DataFrame, message: str) -> None:
    examples = problems.take(5)
    if examples:
        raise ValueError(f"{message}, e.g. {[row.asDict() for row in examples]}")


def backfill_gsp_cube(
    df: DataFrame,
    registry: DataFrame,
    expected: DataFrame,
    start: datetime | str,
    end: datetime | str,
    step: str = "30 MINUTES",
    key: str = "gsp_id",
    ts: str = "datetime_gmt",
) -> DataFrame:
    """Landed area history in [start, end] as a time by area table.

    The areas of the cube are the expected ones. Their list must equal the registry, a time may occur once per area and every step must
    be there for every area; anything else is an error.
    """
    _refuse(registry_equality(registry, expected), "the lists of areas differ")
    inside = time_window(df, ts, start, end)
    _refuse(duplicate_timestamps(inside, [key, ts]), "duplicate times")
    _refuse(
        grid_completeness(inside, expected.select(key), start, end, step, ts), "missing times"
    )
    # the columns of a table: a list that the registry has confirmed
    ids = sorted(row[0] for row in expected.select(key).distinct().collect())
    unknown = fact_join(inside, expected.select(key).distinct(), key, "left_anti")
    _refuse(unknown.select(key).distinct(), "areas that are not in the list")
    return pivot_cube(inside.withColumnRenamed(ts, "time_utc"), "time_utc", key, CUBE_VALUES, ids)
