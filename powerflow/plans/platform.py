"""Generation and forecasts prepared for the observation store."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from powerflow.functions.metadata import metadata_value
from powerflow.functions.naming import derive_names
from powerflow.functions.times import drop_past_horizon, forecast_horizon, utc_literal
from powerflow.functions.units import kw_to_watts, missing_as_null, p50_fraction
from powerflow.operators.capacity import capacity_updates, max_generation_default
from powerflow.operators.curtailment import POTENTIAL
from powerflow.operators.grouping import newest_poll
from powerflow.operators.matching import country_isolation, drop_existing, join_locations
from powerflow.operators.quality import drop_over_capacity
from powerflow.operators.registry import capacity_history
from powerflow.settings import CountryProfile
from powerflow.sources.history import since_batch

OBSERVATION_KEY = ("location_uuid", "energy_source", "observer_name", "timestamp_utc")


class SavedGeneration(NamedTuple):
    """Rows to append for one batch, plus the joined facts they come from."""

    capacity: DataFrame
    observations: DataFrame
    joined: DataFrame


def country_locations(registry: DataFrame, profile: CountryProfile) -> DataFrame:
    """Registry rows the facts of a country may use."""
    own = registry.filter(
        F.col("location_type").isin(*profile.location_types)
        & F.col("energy_source").isin(*profile.energy_sources)
    )
    return country_isolation(own, profile.country)


def no_curtailment_variant(df: DataFrame) -> DataFrame:
    """The same rows with the potential generation as their generation."""
    return df.withColumn("solar_generation_kw", F.col(POTENTIAL))


def with_names(df: DataFrame, profile: CountryProfile) -> DataFrame:
    """Facts with their text key and observer."""
    if profile.id_key == "name" and "name" not in df.columns:
        df = df.withColumn("name", derive_names("asset", F.col("energy_type")))
    if profile.observer is None:
        observer = derive_names("observer", F.col("regime"))
    else:
        observer = F.lit(profile.observer)
    return df.withColumn("observer_name", observer)


def enriched_observations(joined: DataFrame) -> DataFrame:
    """Whole watts per location and time, above-capacity and missing values removed."""
    return drop_over_capacity(joined).select(
        "location_uuid",
        "energy_source",
        "observer_name",
        F.col("target_datetime_utc").alias("timestamp_utc"),
        kw_to_watts(missing_as_null(F.col("solar_generation_kw"))).alias("value_watts"),
    ).filter(F.col("value_watts").isNotNull())


def save_generation(
    df: DataFrame,
    registry: DataFrame,
    existing: DataFrame,
    profile: CountryProfile,
) -> SavedGeneration:
    """Capacity history and new observations of a batch.

    The two results share scan and join but not columns, so each prunes its own. A key is stored once,
    with the larger of two values should the feed have both. Stored rows are
    matched on the whole key, whatever their date; the batch's first timestamp bounds what is read
    and comes from the feed itself, a superset of the joined rows that needs no join.
    """
    named = with_names(df, profile)
    facts = max_generation_default(named, profile.id_key)
    joined = join_locations(facts, country_locations(registry, profile), profile)
    capacity = capacity_history(capacity_updates(joined))
    fresh = newest_poll(enriched_observations(joined), OBSERVATION_KEY)
    stored = since_batch(existing, df, "timestamp_utc", "target_datetime_utc")
    observations = drop_existing(fresh, stored, OBSERVATION_KEY)
    return SavedGeneration(capacity, observations, joined)


def national_location(registry: DataFrame, profile: CountryProfile) -> DataFrame:
    """Candidates for the national location: grid area 0 for GB, else the country's NATION rows."""
    nations = country_isolation(
        registry.filter(
            (F.col("location_type") == "NATION") & (F.col("energy_source") == "SOLAR")
        ),
        profile.country,
    )
    if profile.country == "gb":
        return nations.filter(metadata_value(F.col("metadata"), "gsp_id", "number") == 0)
    return nations


def save_forecast(
    df: DataFrame,
    registry: DataFrame,
    profile: CountryProfile,
    tag: str,
    version: str,
    init: datetime | str,
) -> DataFrame:
    """Forecast values of one run for the national location.

    That location is a single row, looked up once; its absence or a capacity that is not positive
    is an error.
    """
    found = national_location(registry, profile).orderBy("location_name").take(1)
    if not found:
        raise ValueError(f"no national location for {profile.country!r}")
    location = found[0]
    watts = location["effective_capacity_watts"]
    if watts is None or watts <= 0:
        raise ValueError(f"national location of {profile.country!r} has capacity {watts}")
    run = utc_literal(init)
    values = df.select(
        derive_names("forecaster", F.lit(tag)).alias("forecaster_name"),
        F.lit(version).alias("forecaster_version"),
        F.lit(location["location_uuid"]).alias("location_uuid"),
        F.lit("SOLAR").alias("energy_source"),
        run.cast(df.schema["target_datetime_utc"].dataType).alias("init_time_utc"),
        "target_datetime_utc",
        p50_fraction(F.col("solar_generation_kw"), F.lit(watts)).alias("p50_fraction"),
    )
    ahead = drop_past_horizon(forecast_horizon(values, run))
    return ahead.select(
        "forecaster_name",
        "forecaster_version",
        "location_uuid",
        "energy_source",
        "init_time_utc",
        "horizon_mins",
        "p50_fraction",
    )
