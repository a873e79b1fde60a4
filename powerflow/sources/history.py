"""Stored history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from powerflow.functions.times import utc_literal
from powerflow.operators.grouping import fact_join


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything has been written at the path."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Stored Parquet table, or no rows when nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def since_batch(
    obs: DataFrame, batch: DataFrame, stored_ts: str, batch_ts: str
) -> DataFrame:
    """Stored rows from the first timestamp of the batch on.

    The bound is a scalar subquery, so it reaches the scan of the stored table; when the table is
    partitioned by ``date``, older partitions are not read at all.
    """
    earliest = batch.agg(F.min(batch_ts)).scalar()
    if "date" in obs.columns:
        obs = obs.filter(F.col("date") >= F.to_date(earliest))
    return obs.filter(F.col(stored_ts) >= earliest)


def days_of(batch: DataFrame, ts: str) -> list[date]:
    """The days a batch has rows of, however many rows; a batch of polls has a few."""
    days = batch.select(F.to_date(ts).alias("day")).distinct().collect()
    return sorted(row["day"] for row in days if row["day"] is not None)


def on_days(stored: DataFrame, days: Sequence[date]) -> DataFrame:
    """Stored rows of some days of a table that is partitioned by ``date``.

    The days are literals, so the scan lists the folders of these days only: a late row costs its own
    day and not all that has been stored since.
    """
    return stored.filter(F.col("date").isin(list(days)) if days else F.lit(False))


def read_existing_observations(
    obs: DataFrame,
    batch: DataFrame,
    observer: str,
    now: datetime | str,
    location: str = "location_uuid",
    stored_ts: str = "timestamp_utc",
    batch_ts: str = "target_datetime_utc",
    observer_col: str = "observer_name",
) -> DataFrame:
    """Stored observations of one observer, for the batch's locations, from its start up to now."""
    own = since_batch(obs.filter(F.col(observer_col) == observer), batch, stored_ts, batch_ts)
    recent = own.filter(F.col(stored_ts) <= utc_literal(now))
    return fact_join(recent, batch.select(location).distinct(), location, "left_semi")
