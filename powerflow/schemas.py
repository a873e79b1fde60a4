"""Explicit schemas (DDL text) of landed feeds and stored tables. Nothing is inferred."""

from __future__ import annotations

TAGGED_MAP = "map<string,struct<number_value:double,string_value:string>>"

# Columns every feed delivers
CONTRACT = ("target_datetime_utc", "solar_generation_kw")

# Records inside landed JSON documents
# (the ids and codes of a Dutch record are not delivered and not parsed)
NL_RECORD = (
    "capacity double, volume double, percentage double, "
    "validfrom string, validto string, lastupdate string"
)
BE_RECORD = (
    "datetime string, region string, realtime double, mostrecentforecast double, "
    "measured double, monitoredcapacity double"
)
IND_RECORD = "Average2 double, SourceTimeSec string, scada_name string"
GB_FORECAST_RECORD = "DATE_GMT string, TIME_GMT string, EMBEDDED_SOLAR_FORECAST double"
RESOURCE_RECORD = "path string"

RAW_GSP = (
    "gsp_id int, datetime_gmt timestamp, generation_mw double, installedcapacity_mwp double, "
    "capacity_mwp double, updated_gmt timestamp"
)

# Delivered columns per feed, as (landed or computed name, delivered name)
FEEDS = {
    "gb_generation": [
        ("solar_generation_kw", "solar_generation_kw"),
        ("datetime_gmt", "target_datetime_utc"),
        ("capacity_kw", "capacity_kw"),
        ("capacity_no_degradation_kw", "capacity_no_degradation_kw"),
        ("updated_gmt", "pvlive_updated_utc"),
        ("regime", "regime"),
        ("gsp_id", "gsp_id"),
    ],
    "forecast": [
        ("target_datetime_utc", "target_datetime_utc"),
        ("solar_generation_kw", "solar_generation_kw"),
    ],
    "nl": [
        ("capacity", "capacity (kW)"),
        ("volume", "volume (kWh)"),
        ("validfrom", "target_datetime_utc"),
        ("validto", "validto (UTC)"),
        ("lastupdate", "lastupdate (UTC)"),
        ("region_id", "region_id"),
        ("update_capacity", "update_capacity"),
        ("capacity_kw", "capacity_kw"),
        ("solar_generation_kw", "solar_generation_kw"),
    ],
    "be": [
        ("target_datetime_utc", "target_datetime_utc"),
        ("solar_generation_kw", "solar_generation_kw"),
        ("region", "region"),
        ("forecast_type", "forecast_type"),
        ("capacity_kw", "capacity_kw"),
    ],
    "de_generation": [
        ("target_datetime_utc", "target_datetime_utc"),
        ("solar_generation_kw", "solar_generation_kw"),
        ("capacity_kw", "capacity_kw"),
        ("region", "region"),
        ("tso_zone", "tso_zone"),
    ],
    "de_forecast": [
        ("target_datetime_utc", "target_datetime_utc"),
        ("solar_generation_kw", "solar_generation_kw"),
        ("region", "region"),
        ("forecast_type", "forecast_type"),
    ],
    "ind_generation": [
        ("energy_type", "energy_type"),
        ("target_datetime_utc", "target_datetime_utc"),
        ("solar_generation_kw", "solar_generation_kw"),
    ],
    "site": [
        ("solar_generation_kw", "power_kw"),
        ("target_datetime_utc", "start_utc"),
        ("energy_type", "energy_type"),
        ("client_site_name", "client_site_name"),
    ],
}

EMPTY_FEED = "target_datetime_utc timestamp, solar_generation_kw double"

LOCATIONS_CSV = (
    "name string, latitude double, longitude double, region_id int, region string, "
    "country_code string, location_type string, energy_source string"
)
WEIGHTS = "target int, source int, weight double, pos int"
SITES = "site_key string, client_site_name string, latitude double, longitude double"

# Stored tables
LOCATION_REGISTRY = (
    "location_uuid string, location_name string, energy_source string, location_type string, "
    "geometry_wkt string, effective_capacity_watts double, "
    f"metadata {TAGGED_MAP}, valid_from_utc timestamp"
)
CAPACITY_HISTORY = (
    "location_uuid string, energy_source string, new_effective_capacity_watts bigint, "
    f"valid_from_utc timestamp, metadata {TAGGED_MAP}"
)
OBSERVATIONS = (
    "location_uuid string, energy_source string, observer_name string, "
    "timestamp_utc timestamp, value_watts bigint"
)
OBSERVATIONS_STORED = f"{OBSERVATIONS}, date date"
FORECAST_VALUES = (
    "forecaster_name string, forecaster_version string, location_uuid string, "
    "energy_source string, init_time_utc timestamp, horizon_mins int, p50_fraction double"
)
OBSERVERS = "observer_name string"
FORECASTERS = "name string, version string"
FORECAST_VALUES_STORED = f"{FORECAST_VALUES}, init_date date, run string"
SITE_REGISTRY = (
    "client_site_name string, country string, latitude double, longitude double, "
    "capacity_kw bigint"
)
SITE_GENERATION = (
    "power_kw double, start_utc timestamp, energy_type string, client_site_name string"
)
SITE_GENERATION_STORED = f"{SITE_GENERATION}, date date"
SITE_FORECAST = (
    "forecast_power_kw double, start_utc timestamp, end_utc timestamp, horizon_minutes double, "
    "client_site_name string, timestamp_utc timestamp, ml_model_name string, "
    "forecast_version string"
)
SITE_FORECAST_STORED = f"{SITE_FORECAST}, init_date date, run string"
