"""Incremental ingest of landed feeds.

Polls overlap on purpose, so the same (location, time, observer) arrives several times and in any
order. Each is stored once by an anti join against the stored table in every micro-batch. Stores are
partitioned by the date of a time that belongs to the key, and a micro-batch reads the keys of its own
days only, so its reading follows the batch and not the store, and a late row costs its own day. State
with a watermark would forget keys and drop late rows, so none is kept; a micro-batch that is
repeated after a lost executor finds its rows already stored. Rules that compare rows work within one
response, so results do not depend on how files fall into micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from powerflow.operators.grouping import newest_poll
from powerflow.operators.matching import drop_existing, join_locations
from powerflow.plans.platform import OBSERVATION_KEY, enriched_observations, with_names
from powerflow.schemas import OBSERVATIONS_STORED
from powerflow.settings import CountryProfile
from powerflow.session import shared_table
from powerflow.sinks.tables import append_observations, append_rows
from powerflow.sources.landed import LANDED
from powerflow.sources.history import days_of, on_days, read_table


def run_available(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Process everything that has landed since the last run, then stop."""
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stored_like(batch: DataFrame, store: str, schema: str, ts: str) -> DataFrame:
    """What the store has of the batch's days."""
    return on_days(read_table(batch.sparkSession, store, schema), days_of(batch, ts))


def stream_ingest(
    stream: DataFrame,
    store: str,
    checkpoint: str,
    keys: Sequence[str] = OBSERVATION_KEY,
    ts: str = "timestamp_utc",
    order: Sequence[str] = (LANDED,),
    schema: str = OBSERVATIONS_STORED,
) -> StreamingQuery:
    """Store each key once, whatever the number and order of its arrivals.

    What is stored first stays. Of rows in one micro-batch the newest poll counts, by the ``order`` columns
    that the stream has.
    """

    fields = T.StructType.fromDDL(schema).fieldNames()

    def write(batch: DataFrame, _: int) -> None:
        newest = newest_poll(batch, keys, order).drop(*[c for c in order if c not in fields])
        with shared_table(newest, "micro-batch") as unique:
            append_observations(drop_existing(unique, stored_like(unique, store, schema, ts), keys), store, ts)

    return run_available(stream, write, checkpoint)


def stream_enrich_guard(
    stream: DataFrame, locations: DataFrame, profile: CountryProfile
) -> DataFrame:
    """Stream of facts joined to the registry, capacity rules applied, in whole watts.

    Stateless: the same join and filters as in batch.
    """
    return enriched_observations(join_locations(with_names(stream, profile), locations, profile))


def stream_settled(
    stream: DataFrame,
    store: str,
    checkpoint: str,
    keys: Sequence[str],
    schema: str,
    lag: str = "15 minutes",
    validto: str = "validto",
    lastupdate: str = "lastupdate",
    response_update: str = "response_update",
) -> StreamingQuery:
    """Store each key of the settled rows once.

    A row is settled if it ended more than ``lag`` before the latest update of the response it came with,
    which the stream brings as ``response_update`` (a response is one document, so it is known row by
    row). Held back rows come again, corrected, with a later poll. The newest of a micro-batch counts;
    what is stored first stays. ``validto`` belongs to the key: all rows of a key have the same. The store
    is partitioned by its ``date``.
    """
    ripe = F.col(validto) < F.col(response_update) - F.expr(f"INTERVAL {lag}")
    fields = T.StructType.fromDDL(schema).fieldNames()

    def write(batch: DataFrame, _: int) -> None:
        newest = newest_poll(batch.filter(ripe), keys, [lastupdate, response_update]).select(*fields)
        with shared_table(newest, "micro-batch") as unique:
            stored = stored_like(unique, store, f"{schema}, date date", validto)
            fresh = drop_existing(unique, stored, keys).withColumn("date", F.to_date(validto))
            append_rows(fresh, store, ["date"])

    return run_available(stream, write, checkpoint)
