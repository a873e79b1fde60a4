"""Timestamp parsing, zones, flooring and forecast horizons.

Every function accepts TIMESTAMP and TIMESTAMP_NTZ columns; the session zone is UTC.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from powerflow.functions.naming import stripped


def as_utc(moment: datetime | str) -> datetime:
    """Naive UTC datetime from an aware or naive one, or from ISO text."""
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    return moment.astimezone(UTC).replace(tzinfo=None) if moment.tzinfo else moment


def utc_literal(moment: datetime | str) -> Column:
    """Literal that compares with both timestamp types and still reaches the Parquet filter."""
    return F.lit(as_utc(moment).isoformat(sep=" ")).cast("timestamp_ntz")


def parse_date_time(date_col: Column, time_col: Column) -> Column:
    """Date text (first ten characters) plus ``H:mm`` text; anything invalid gives NULL."""
    text = F.concat(F.substring(date_col, 1, 10), F.lit(" "), stripped(time_col))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd H:mm"))


def parse_iso_utc(col: Column) -> Column:
    """ISO-8601 text, with or without an offset or seconds; anything invalid gives NULL."""
    without_seconds = F.try_to_timestamp(col, F.lit("yyyy-MM-dd'T'HH:mmXXX"))
    return F.coalesce(F.try_to_timestamp(col), without_seconds)


def epoch_to_utc(col: Column) -> Column:
    """Epoch seconds, number or text."""
    return F.timestamp_seconds(col.cast("bigint"))


def local_to_utc(col: Column, zone: str) -> Column:
    """Wall-clock time of a zone to UTC. The repeated autumn hour maps to its first occurrence."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), col.cast("timestamp_ntz"))


def floor_time(col: Column, minutes: int) -> Column:
    """Floor to a step that divides one day, keeping the column's timestamp type."""
    if minutes <= 0 or 1440 % minutes:
        raise ValueError(f"{minutes} minutes does not divide a day")
    past = (F.hour(col) * 60 + F.minute(col)) % minutes
    return col - F.make_dt_interval(mins=past, secs=F.extract(F.lit("SECOND"), col))


def minutes_between(end: Column, start: Column) -> Column:
    """Exact minutes from start to end, as a double."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(60_000_000.0)


def forecast_horizon(
    df: DataFrame,
    init: Column,
    ts: str = "target_datetime_utc",
    step_minutes: int = 15,
) -> DataFrame:
    """Add the end of each step, its horizon in minutes and the horizon truncated to an integer."""
    horizon = minutes_between(F.col(ts), init)
    return df.withColumns(
        {
            "end_utc": F.col(ts) + F.make_dt_interval(mins=F.lit(step_minutes)),
            "horizon_minutes": horizon,
            "horizon_mins": horizon.cast("int"),
        }
    )


def drop_past_horizon(df: DataFrame, horizon: str = "horizon_mins") -> DataFrame:
    """Drop steps before the run; compared after truncation, so half a minute early stays."""
    return df.filter(F.col(horizon) >= 0)
