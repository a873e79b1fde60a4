"""Solar and wind generation of Rajasthan."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from powerflow.functions.naming import canonical_schema
from powerflow.functions.times import epoch_to_utc
from powerflow.functions.units import missing_as_null, mw_to_kw
from powerflow.operators.grouping import newest_poll
from powerflow.operators.quality import drop_negative_power, flag_stale
from powerflow.operators.series import first_per_asset
from powerflow.schemas import IND_RECORD
from powerflow.settings import IND_ASSETS
from powerflow.sources.landed import LANDED, records_array


def ind_assets(raw: DataFrame, now: datetime | str) -> DataFrame:
    """First record per asset and document, with ``is_stale`` for wind older than one hour."""
    landed = [name for name in (LANDED,) if name in raw.columns]
    documents = raw.select(
        *landed,
        records_array(F.col("document"), "data[].0", IND_RECORD, strict=True).alias("records")
    )
    assets = first_per_asset(documents, "records", IND_ASSETS).select(
        "energy_type",
        epoch_to_utc(F.col("asset.SourceTimeSec")).alias("target_datetime_utc"),
        mw_to_kw(missing_as_null(F.col("asset.Average2"))).alias("solar_generation_kw"),
        *landed,
    )
    newest = newest_poll(assets, ["energy_type", "target_datetime_utc"], [LANDED])
    known = drop_negative_power(newest.drop(*landed))
    return flag_stale(known, now, "1 HOUR", F.col("energy_type") == "wind")


def ind_generation(raw: DataFrame, now: datetime | str) -> DataFrame:
    """Generation per asset. Stale wind stays; documents that are not JSON are an error."""
    return canonical_schema(ind_assets(raw, now), "ind_generation")
