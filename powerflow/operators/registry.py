"""Upkeep of locations, sites, forecasters and capacity history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from powerflow.functions.metadata import merge_metadata, number_tag, string_tag
from powerflow.functions.naming import lookup_map, point_wkt
from powerflow.functions.times import utc_literal
from powerflow.operators.grouping import latest_per_location
from powerflow.schemas import TAGGED_MAP
from powerflow.settings import (
    DE_TSO_CAPACITY_KW,
    DEFAULT_LOCATION_WATTS,
    NL_SITE_CAPACITY_KW,
    CountryProfile,
)

VALID_FROM = "2020-01-01 00:00:00"


def location_id(name: Column) -> Column:
    """Stable identifier of a location, in UUID form, derived from its name."""
    digest = F.sha2(name, 256)
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in parts])


def seed_locations(
    locations: DataFrame, seeds: DataFrame | None, profile: CountryProfile
) -> DataFrame:
    """Registry rows for every known location of a country.

    The capacity comes from the seeds (key, ``seed_watts``) or is the default.
    """
    key = profile.id_key
    capacity = F.lit(DEFAULT_LOCATION_WATTS)
    if seeds is not None:
        locations = locations.join(seeds, key, "left")
        capacity = F.coalesce(F.col("seed_watts"), capacity)
    tag = number_tag if profile.metadata_kind == "number" else string_tag
    metadata = F.create_map(
        F.lit("country"), string_tag(F.lit(profile.country)), F.lit(key), tag(F.col(key))
    )
    source = F.lower(F.coalesce(F.col("energy_source"), F.lit("solar")))
    return locations.select(
        location_id(F.col("name")).alias("location_uuid"),
        F.col("name").alias("location_name"),
        F.when(source == "wind", "WIND").otherwise("SOLAR").alias("energy_source"),
        F.when(F.col("location_type") == "STATE", "STATE").otherwise("NATION").alias(
            "location_type"
        ),
        point_wkt(F.col("longitude"), F.col("latitude")).alias("geometry_wkt"),
        capacity.cast("double").alias("effective_capacity_watts"),
        metadata.cast(TAGGED_MAP).alias("metadata"),
        utc_literal(VALID_FROM).cast("timestamp").alias("valid_from_utc"),
    )


def default_site_capacity(country: str, name: Column) -> Column:
    if country == "de":
        return lookup_map(name, DE_TSO_CAPACITY_KW).cast("bigint")
    return F.lit(NL_SITE_CAPACITY_KW if country == "nl" else 0).cast("bigint")


def missing_sites(stored: DataFrame, wanted: DataFrame, country: str) -> DataFrame:
    """Registry rows for wanted sites that are not stored yet."""
    name = F.col("client_site_name")
    absent = wanted.join(stored, "client_site_name", "left_anti")
    return absent.select(
        name,
        F.lit(country).alias("country"),
        "latitude",
        "longitude",
        F.coalesce(F.col("capacity_override_kw"), default_site_capacity(country, name)).alias(
            "capacity_kw"
        ),
    )


def get_or_create_site(stored: DataFrame, wanted: DataFrame, country: str) -> DataFrame:
    """Stored sites plus the wanted ones that were missing."""
    return stored.unionByName(missing_sites(stored, wanted, country))


def update_site_capacity(stored: DataFrame, overrides: DataFrame) -> DataFrame:
    """Sites with their capacity replaced where it moved by at least 1 kW, up or down.

    ``is_updated`` tells which ones changed.
    """
    joined = stored.join(
        overrides.select("client_site_name", "capacity_override_kw"), "client_site_name", "left"
    )
    moved = F.abs(F.col("capacity_override_kw") - F.col("capacity_kw")) >= 1
    changed = F.coalesce(moved, F.lit(False))
    return joined.withColumns(
        {
            "is_updated": changed,
            "capacity_kw": F.when(changed, F.col("capacity_override_kw")).otherwise(
                F.col("capacity_kw")
            ),
        }
    ).drop("capacity_override_kw")


def upsert_forecaster(stored: DataFrame, wanted: DataFrame) -> DataFrame:
    """What to do with each wanted (name, version): ``reuse``, ``new_version`` or ``create``."""
    exact = stored.select("name", "version").distinct().withColumn("_same", F.lit(True))
    known = stored.select("name").distinct().withColumn("_known", F.lit(True))
    joined = wanted.join(exact, ["name", "version"], "left").join(known, "name", "left")
    action = (
        F.when(F.col("_same"), "reuse").when(F.col("_known"), "new_version").otherwise("create")
    )
    return joined.select("name", "version", action.alias("action"))


def capacity_history(updates: DataFrame, ts: str = "target_datetime_utc") -> DataFrame:
    """History rows to append: the new capacity is valid from the time of its row.

    Feeds that publish a capacity without degradation also store it in the metadata.
    """
    metadata = F.col("metadata")
    undegraded = "capacity_no_degradation_kw"
    if undegraded in updates.columns:
        metadata = merge_metadata(metadata, undegraded, F.col(undegraded))
    return updates.select(
        "location_uuid",
        "energy_source",
        F.col("new_effective_capacity_watts").cast("bigint").alias("new_effective_capacity_watts"),
        F.col(ts).alias("valid_from_utc"),
        metadata.alias("metadata"),
    )


def current_locations(registry: DataFrame, history: DataFrame) -> DataFrame:
    """Registry with the newest capacity and metadata of the history applied."""
    newest = latest_per_location(
        history, "location_uuid", "valid_from_utc", [F.col("new_effective_capacity_watts").desc()]
    ).select(
        "location_uuid",
        F.col("new_effective_capacity_watts").cast("double").alias("_watts"),
        F.col("metadata").alias("_metadata"),
        F.col("valid_from_utc").alias("_from"),
    )
    return (
        registry.join(newest, "location_uuid", "left")
        .withColumns(
            {
                "effective_capacity_watts": F.coalesce("_watts", "effective_capacity_watts"),
                "metadata": F.coalesce("_metadata", "metadata"),
                "valid_from_utc": F.coalesce("_from", "valid_from_utc"),
            }
        )
        .drop("_watts", "_metadata", "_from")
    )
