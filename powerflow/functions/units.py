"""Power, capacity and fraction arithmetic. Missing values are NULL, never NaN."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_as_null(col: Column) -> Column:
    """NaN and NULL both become NULL."""
    return F.nanvl(col, F.lit(None).cast("double"))


def mw_to_kw(col: Column, factor: float = 1000.0) -> Column:
    return col * F.lit(factor)


def kw_to_watts(col: Column) -> Column:
    """Whole watts, truncated toward zero; a missing value stays missing."""
    return (missing_as_null(col) * F.lit(1000)).cast("bigint")


def capacity_from_percentage(power: Column, fraction: Column) -> Column:
    """Capacity from the power and the fraction of it in use; NULL when the fraction is zero."""
    return F.try_divide(power, fraction)


def p50_fraction(kw: Column, capacity_watts: Column) -> Column:
    """Forecast power as a fraction of capacity. A capacity that is not positive is an error."""
    return F.when(capacity_watts > 0, kw * F.lit(1000) / capacity_watts).otherwise(
        F.raise_error(F.lit("effective capacity must be positive"))
    )


def cast_float32(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("float") for name in cols})
