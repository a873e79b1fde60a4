"""Dutch generation per region and the national forecast.

Landed documents carry the request they answer: ``region_id`` and ``request_date``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from powerflow.functions.naming import canonical_schema
from powerflow.functions.times import parse_iso_utc
from powerflow.functions.units import capacity_from_percentage
from powerflow.operators.capacity import validate_capacity
from powerflow.operators.curtailment import potential_generation
from powerflow.operators.grouping import newest_poll
from powerflow.operators.quality import flag_small_percentage
from powerflow.schemas import NL_RECORD
from powerflow.settings import NL_REGION_IDS
from powerflow.sources.landed import LANDED, records_array
from powerflow.sources.windows import feed_window, time_window

REQUEST = ("request_date", "region_id")


def nl_records(raw: DataFrame) -> DataFrame:
    """Records of the landed documents with parsed times.

    ``response_update`` is the latest update within the response a record came with.
    """
    known = [*REQUEST, *[name for name in (LANDED,) if name in raw.columns]]
    array = records_array(F.col("document"), "hydra:member[]", NL_RECORD, strict=True)
    records = raw.select(*known, array.alias("records"))
    latest = F.array_max(
        F.transform("records", lambda record: parse_iso_utc(record.getField("lastupdate")))
    )
    flat = records.select(*known, latest.alias("response_update"), F.inline("records"))
    times = {n: parse_iso_utc(F.col(n)) for n in ("validfrom", "validto", "lastupdate")}
    return flat.withColumns(times)


def settled_records(records: DataFrame, lag: str = "15 minutes") -> DataFrame:
    """Records that ended more than ``lag`` before the latest update of their response.

    A response is one landed document, so the rule needs no shuffle.
    """
    return records.filter(F.col("validto") < F.col("response_update") - F.expr(f"INTERVAL {lag}"))


def nl_delivered(records: DataFrame, region_ids: Sequence[int]) -> DataFrame:
    """Capacity from the percentage, delivered columns and the capacity check."""
    totals = flag_small_percentage(records).withColumns(
        {
            "capacity_kw": capacity_from_percentage(F.col("capacity"), F.col("percentage")),
            "solar_generation_kw": F.col("capacity"),
            "region_id": F.col("region_id").cast("int"),
        }
    )
    return validate_capacity(canonical_schema(totals, "nl"), region_ids)


def newest_records(records: DataFrame) -> DataFrame:
    """The newest record per region and period. Rules within a response come before."""
    return newest_poll(records, ["region_id", "validfrom"], ["lastupdate", "response_update", LANDED])


def _windowed(records: DataFrame, feed: str, now: datetime | str | None) -> DataFrame:
    if now is None:
        return records
    start, end = feed_window(feed, now)
    return time_window(records, "validfrom", start, end)


def nl_generation(
    raw: DataFrame,
    now: datetime | str | None,
    prices: DataFrame | None = None,
    region_ids: Sequence[int] = NL_REGION_IDS,
) -> DataFrame:
    """Settled generation since yesterday; with prices also the potential generation.

    Without ``now`` everything that has landed.
    """
    settled = settled_records(nl_records(raw))
    newest = newest_records(_windowed(settled, "nl_generation", now))
    delivered = nl_delivered(newest, region_ids)
    return delivered if prices is None else potential_generation(delivered, prices)


def nl_forecast(
    raw: DataFrame, now: datetime | str | None, region_ids: Sequence[int] = NL_REGION_IDS
) -> DataFrame:
    """National forecast from two hours back to seven days ahead."""
    newest = newest_records(_windowed(nl_records(raw), "nl_forecast", now))
    return nl_delivered(newest, region_ids)
