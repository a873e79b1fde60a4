"""Generation and forecasts prepared for the site store."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from powerflow.functions.naming import canonical_schema, tag_constants
from powerflow.functions.times import as_utc, forecast_horizon, utc_literal
from powerflow.operators.capacity import capacity_override
from powerflow.operators.matching import route_by_key
from powerflow.operators.registry import get_or_create_site, update_site_capacity

FORECAST_SITE = "nl_national"


class SavedSites(NamedTuple):
    """Sites after the batch and the rows to append."""

    sites: DataFrame
    rows: DataFrame


def site_generation(
    df: DataFrame, sites: DataFrame, stored: DataFrame, key: str, country: str
) -> SavedSites:
    """Rows per site, with sites created and their capacity refreshed as needed.

    Only sites with rows in the batch are created. Rows of other keys are ignored.
    """
    routed = route_by_key(df, sites, key)
    if "energy_type" not in df.columns:
        routed = tag_constants(routed, energy_type="solar")
    if "capacity_kw" in df.columns:
        overrides = capacity_override(routed, "client_site_name")
    else:
        overrides = routed.select("client_site_name").distinct().withColumn(
            "capacity_override_kw", F.lit(None).cast("bigint")
        )
    wanted = overrides.join(sites.drop("site_key"), "client_site_name")
    known = get_or_create_site(stored, wanted, country)
    updated = update_site_capacity(known, overrides).drop("is_updated")
    return SavedSites(updated, canonical_schema(routed, "site"))


def site_forecast(
    df: DataFrame, site: str, model: str, version: str, now: datetime | str
) -> DataFrame:
    """Forecast rows of one site: quarter-hour steps with their horizon from the run."""
    now = as_utc(now)
    run = utc_literal(now.replace(minute=now.minute - now.minute % 15, second=0, microsecond=0))
    steps = df.select(
        F.col("solar_generation_kw").alias("forecast_power_kw"),
        F.col("target_datetime_utc").alias("start_utc"),
    )
    dated = forecast_horizon(steps, run, "start_utc").drop("horizon_mins")
    return dated.select(
        "forecast_power_kw",
        "start_utc",
        "end_utc",
        "horizon_minutes",
        F.lit(site).alias("client_site_name"),
        run.cast(df.schema["target_datetime_utc"].dataType).alias("timestamp_utc"),
        F.lit(model).alias("ml_model_name"),
        F.lit(version).alias("forecast_version"),
    )
