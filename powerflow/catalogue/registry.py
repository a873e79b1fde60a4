"""Registered queries: one callable per operator and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from powerflow.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, the type the SQL side returns."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(f"`{name}`").cast("timestamp_ntz") for name in zoned})


def query(name: str, sql: str | None = None, *views: str) -> Callable[[Query], Query]:
    """Register a query; ``views`` are the common table expressions its SQL uses."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain_times(build(configure(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = f"WITH {', '.join(views)} {sql}" if views else sql
        return build

    return register
