"""Belgian generation and forecast, national and regional."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from powerflow.functions.naming import canonical_schema, normalise_key, tag_constants
from powerflow.functions.times import parse_iso_utc
from powerflow.functions.units import missing_as_null, mw_to_kw
from powerflow.operators.grouping import newest_poll
from powerflow.operators.quality import drop_incomplete
from powerflow.schemas import FEEDS
from powerflow.sources.landed import LANDED, flatten_records
from powerflow.sources.windows import feed_window, time_window

NATIONAL = "belgium"


def _be_feed(
    raw: DataFrame, value: str, kind: str, now: datetime | str | None, hours: float | None
) -> DataFrame:
    # only the measure that is delivered is parsed out of the documents
    record = f"datetime string, region string, {value} double, monitoredcapacity double"
    landed = [name for name in (LANDED,) if name in raw.columns]
    records = flatten_records(raw, "results[]", record, keep=landed, strict=True)
    converted = tag_constants(
        records.select(
            parse_iso_utc(F.col("datetime")).alias("target_datetime_utc"),
            mw_to_kw(missing_as_null(F.col(value))).alias("solar_generation_kw"),
            normalise_key(F.col("region")).alias("region"),
            mw_to_kw(missing_as_null(F.col("monitoredcapacity"))).alias("capacity_kw"),
            *landed,
        ),
        forecast_type=kind,
    )
    complete = drop_incomplete(converted, [target for _, target in FEEDS["be"]])
    if now is not None:
        start, end = feed_window("be", now, hours)
        complete = time_window(complete, "target_datetime_utc", start, end)
    newest = newest_poll(complete, ["region", "target_datetime_utc"], [LANDED])
    return canonical_schema(newest, "be")


def be_generation(
    raw: DataFrame, now: datetime | str | None = None, backfill_hours: float | None = None
) -> DataFrame:
    """Measured generation; without ``now`` everything that has landed."""
    return _be_feed(raw, "realtime", "generation", now, backfill_hours)


def be_forecast(
    raw: DataFrame, now: datetime | str | None = None, backfill_hours: float | None = None
) -> DataFrame:
    """Most recent forecast; without ``now`` everything that has landed."""
    return _be_feed(raw, "mostrecentforecast", "most_recent", now, backfill_hours)
