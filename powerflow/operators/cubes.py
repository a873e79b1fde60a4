"""Dense time by location tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def only(col: Column) -> Column:
    """Aggregate: the single value of a cell; a cell that occurs twice is an error."""
    twice = F.raise_error(F.lit("a location has several rows for one time"))
    return F.when(F.count(F.lit(1)) > 1, twice).otherwise(F.max(col))


def pivot_cube(
    df: DataFrame,
    ts: str,
    key: str,
    values: Sequence[str],
    ids: Sequence,
    agg=only,
) -> DataFrame:
    """One row per time, one column per location and value, named ``<id>_<value>``.

    The locations are given, so the pivot needs no pass over the data to find them. With a single
    value the columns are named after the locations alone.
    """
    aggregates = [agg(F.col(name)).alias(name) for name in values]
    return df.groupBy(ts).pivot(key, list(ids)).agg(*aggregates)


def cube_columns(ids: Sequence, values: Sequence[str]) -> list[str]:
    """Names of the measure columns of a cube."""
    if len(values) == 1:
        return [str(i) for i in ids]
    return [f"{i}_{name}" for i in ids for name in values]
