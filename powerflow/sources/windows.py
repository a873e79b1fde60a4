"""Time chunks of a backfill and the look-back windows of the feeds."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from powerflow.functions.times import as_utc, utc_literal

HALF_HOUR = timedelta(minutes=30)
EPOCH = datetime(1970, 1, 1)
MICROSECOND = timedelta(microseconds=1)


def _micros(moment: datetime) -> int:
    return (moment - EPOCH) // MICROSECOND


def _moment(micros: Column) -> Column:
    """Microseconds since 1970 as a timestamp without a zone."""
    start = F.lit(EPOCH.isoformat(sep=" ")).cast("timestamp_ntz")
    return start + F.make_dt_interval(
        F.floor(micros / 86_400_000_000).cast("int"), secs=(F.pmod(micros, F.lit(86_400_000_000)) / F.lit(1_000_000)).cast("decimal(18,6)")
    )


def time_chunks(
    spark: SparkSession,
    start: datetime | str,
    end: datetime | str,
    step: timedelta | None = None,
    n: int | None = None,
) -> DataFrame:
    """Split [start, end) into chunks.

    With ``step`` every chunk has that length, the last one is clipped to the end and empty ones
    are left out (a step of one day gives daily requests). With ``n`` there are n equal chunks
    whose bounds are rounded up to the half hour, empty ones left out. Spark makes the rows and every
    row its own number, so there may be any number of them.
    """
    start, end = as_utc(start), as_utc(end)
    if (step is None) == (n is None):
        raise ValueError("give either a step or a number of chunks")
    first, length = _micros(start), max(0, _micros(end) - _micros(start))
    if step is not None:
        width = step // MICROSECOND
        rows = spark.range(-(-length // width)).select(
            F.col("id").cast("int").alias("chunk_no"),
            (F.lit(first) + F.col("id") * width).alias("low"),
            F.least(F.lit(first) + (F.col("id") + 1) * width, F.lit(first + length)).alias("high"),
        )
    else:
        half_hour = HALF_HOUR // MICROSECOND

        def edge(number: Column) -> Column:
            """Bound of that number, rounded up to the half hour."""
            exact = F.lit(first) + F.floor(number * F.lit(length) / n)
            return F.ceil(exact / half_hour).cast("long") * half_hour

        number = F.col("id")
        if length < n * half_hour:
            # shorter chunks than half an hour: their bounds are all half hours between the first and the last
            first_edge, last_edge = (-(-at // half_hour) * half_hour for at in (first, first + length))
            low = F.lit(first_edge) + number * half_hour
            rows = spark.range((last_edge - first_edge) // half_hour).select("id", low.alias("low"), (low + half_hour).alias("high"))
        else:
            rows = spark.range(n).select("id", edge(number).alias("low"), edge(number + 1).alias("high"))
        rows = rows.select(number.cast("int").alias("chunk_no"), "low", "high")
    return rows.select("chunk_no", _moment(F.col("low")).alias("chunk_start"), _moment(F.col("high")).alias("chunk_end"))


def feed_window(
    feed: str,
    now: datetime | str,
    backfill_hours: float | None = None,
) -> tuple[datetime, datetime]:
    """First and last timestamp a feed delivers, both included."""
    now = as_utc(now)
    midnight = now.replace(hour=0, minute=0, second=0, microsecond=0)
    hours = timedelta(hours=backfill_hours) if backfill_hours is not None else None
    if feed == "gb_in-day":
        return now - (hours or timedelta(hours=2)), now + HALF_HOUR
    if feed == "gb_day-after":
        return midnight - timedelta(days=1), midnight - HALF_HOUR
    if feed == "nl_generation":
        return now.replace(hour=0) - timedelta(days=1), now - timedelta(minutes=15)
    if feed == "nl_forecast":
        return now - timedelta(hours=2), now + timedelta(days=7)
    if feed == "de_generation":
        hour = now.replace(minute=0, second=0, microsecond=0)
        return hour - (hours or timedelta(hours=24)), hour
    if feed == "de_forecast":
        return midnight, midnight + timedelta(days=2)
    if feed == "be":
        return now - (hours or timedelta(days=1)), now
    raise ValueError(f"unknown feed window: {feed}")


def time_window(
    df: DataFrame,
    ts: str,
    start: datetime | str,
    end: datetime | str,
    closed: str = "both",
) -> DataFrame:
    """Keep rows inside the window; ``closed`` is ``both`` or ``left``."""
    if closed not in ("both", "left"):
        raise ValueError(f"unknown interval side: {closed}")
    below = F.col(ts) <= utc_literal(end) if closed == "both" else F.col(ts) < utc_literal(end)
    return df.filter((F.col(ts) >= utc_literal(start)) & below)
