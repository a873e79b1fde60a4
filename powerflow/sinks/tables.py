"""CSV export, Parquet tables that grow by appends or by whole partitions, and cubes.

Appends assume one writer per table at a time: Parquet has no merge, so duplicates are removed by
the anti join before the append. Forecast runs need no such join, a run is a partition of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from powerflow.operators.matching import order_output

CSV_NAME = "forecast_data.csv"
ORM_COLUMN = "_sa_instance_state"
RUN_TIME = "yyyyMMdd'T'HHmmss'Z'"


def write_csv(df: DataFrame, folder: str, order: Sequence[str] = ()) -> str | None:
    """Write ``forecast_data.csv`` with a header and return its path; nothing for an empty frame.

    The result is a folder of part files, each with the header, because one file would send all
    rows through one task. With ``order`` the parts follow that order.
    """
    if df.isEmpty():
        return None
    if not folder:
        raise ValueError("a folder is needed to write CSV")
    path = f"{folder.rstrip('/')}/{CSV_NAME}"
    out = df.drop(ORM_COLUMN)
    if order:
        out = order_output(out, order)
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def append_rows(df: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    """Append to a Parquet table.

    Rows are rebalanced on the partition columns first: small partitions are gathered into few
    files and a large one is split over several tasks.
    """
    rows = df.hint("rebalance", *[F.col(name) for name in partitions]) if partitions else df
    rows.write.mode("append").partitionBy(*partitions).parquet(path)


def append_observations(df: DataFrame, path: str, ts: str = "timestamp_utc") -> None:
    """Append observations, partitioned by observer and date."""
    append_rows(df.withColumn("date", F.to_date(ts)), path, ["observer_name", "date"])


def append_site_generation(df: DataFrame, path: str, ts: str = "start_utc") -> None:
    """Append generation of sites, partitioned by date."""
    append_rows(df.withColumn("date", F.to_date(ts)), path, ["date"])


def append_forecast(
    df: DataFrame, path: str, init: str = "init_time_utc", run: Sequence[str] = ()
) -> None:
    """Store forecast runs, each in a partition of its own: its date and its ``run``.

    A run is named by its time and the ``run`` columns. A run that is there already is replaced as a
    whole when the job commits, so nothing that is stored has to be read, a repeated run changes no
    count and an interrupted one leaves what was there before. Other runs are not touched, and no
    rows replace nothing.
    """
    name = F.concat_ws("_", F.date_format(init, RUN_TIME), *run)
    rows = df.withColumns({"init_date": F.to_date(init), "run": name})
    parts = ["init_date", "run"]
    (
        rows.hint("rebalance", *[F.col(part) for part in parts])
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    )


def write_cube(df: DataFrame, path: str, ts: str, overwrite: bool) -> None:
    """Write a cube in time order; without ``overwrite`` an existing one is an error."""
    ordered = df.repartitionByRange(ts).sortWithinPartitions(ts)
    ordered.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)
