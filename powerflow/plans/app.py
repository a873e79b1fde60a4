"""One scheduled run: a feed into one of the sinks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from powerflow import __version__, schemas
from powerflow.functions.naming import derive_names
from powerflow.functions.times import as_utc
from powerflow.operators.capacity import seed_capacity
from powerflow.operators.grouping import newest_poll
from powerflow.operators.matching import drop_existing, missing_members, unmatched_keys
from powerflow.operators.registry import current_locations, seed_locations, upsert_forecaster
from powerflow.plans.be import NATIONAL
from powerflow.plans.dispatch import FeedRun, feed_dispatch
from powerflow.plans.platform import (
    country_locations,
    no_curtailment_variant,
    save_forecast,
    save_generation,
    with_names,
)
from powerflow.plans.sites import FORECAST_SITE, site_forecast, site_generation
from powerflow.session import config_table, shared_table
from powerflow.settings import (
    FORECASTER_TAGS,
    NL_SITE_CAPACITY_KW,
    SITE_KEYS,
    CountryProfile,
    profile_for,
)
from powerflow.sinks.tables import (
    append_forecast,
    append_observations,
    append_rows,
    append_site_generation,
    write_csv,
)
from powerflow.sources.dimensions import packaged_locations, site_table
from powerflow.sources.history import days_of, on_days, read_table

SINKS = ("csv", "site-db", "data-platform")
# What a stored row is known by: a run that is repeated stores nothing twice
SITE_KEY = ("client_site_name", "energy_type", "start_utc")
FORECAST_KEY = (
    "forecaster_name", "forecaster_version", "location_uuid", "energy_source", "init_time_utc", "horizon_mins",
)
SITE_FORECAST_KEY = ("client_site_name", "ml_model_name", "forecast_version", "timestamp_utc", "start_utc")
# What, besides its time, names a forecast run, which is replaced as a whole
FORECAST_RUN = ("forecaster_name", "forecaster_version", "location_uuid", "energy_source")
SITE_FORECAST_RUN = ("client_site_name", "ml_model_name", "forecast_version")


class Store:
    """Parquet tables below one folder; all grow by appends but for the forecasts, which grow by runs."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str, schema: str) -> DataFrame:
        return read_table(self.spark, self.path(table), schema)

    def locations(self) -> DataFrame:
        """Registry with its capacity history applied."""
        return current_locations(
            self.read("location_registry", schemas.LOCATION_REGISTRY),
            self.read("capacity_history", schemas.CAPACITY_HISTORY),
        )

    def observations(self) -> DataFrame:
        return self.read("observations", schemas.OBSERVATIONS_STORED)


def ensure_observers(store: Store, profile: CountryProfile) -> None:
    required = config_table(
        store.spark,
        [{"observer_name": name} for name in profile.required_observers],
        schemas.OBSERVERS,
    )
    present = store.read("observers", schemas.OBSERVERS)
    missing = missing_members(required, present, "observer_name")
    if not missing.isEmpty():
        append_rows(missing, store.path("observers"))


def ensure_locations(store: Store, data: DataFrame, profile: CountryProfile) -> None:
    """Create a country's locations when it has none. GB locations are never created here."""
    if not profile.seeded or not country_locations(store.locations(), profile).isEmpty():
        return
    seeds = seed_capacity(data, profile.id_key) if profile.id_key in data.columns else None
    rows = seed_locations(packaged_locations(store.spark, profile.country), seeds, profile)
    append_rows(rows, store.path("location_registry"))


def check_matched(joined: DataFrame, facts: DataFrame, loc: DataFrame, profile: CountryProfile):
    """Error when nothing matched although some row has capacity."""
    if not joined.isEmpty():
        return
    has_capacity = F.col("capacity_kw").isNull() | (F.col("capacity_kw") != 0)
    if "capacity_kw" in facts.columns and facts.filter(has_capacity).isEmpty():
        return
    unknown = unmatched_keys(facts, loc, profile).take(20)
    if unknown:
        ids = [row[0] for row in unknown]
        raise ValueError(
            f"no location of {profile.country!r} matches {profile.id_key} values such as {ids}"
        )


def run_platform_generation(store: Store, data: DataFrame, profile: CountryProfile) -> None:
    ensure_observers(store, profile)
    ensure_locations(store, data, profile)
    registry = store.locations()
    saved = save_generation(data, registry, store.observations(), profile)
    own = country_locations(registry, profile)
    check_matched(saved.joined, with_names(data, profile), own, profile)
    append_rows(saved.capacity, store.path("capacity_history"))
    append_observations(saved.observations, store.path("observations"))


def run_platform_forecast(
    store: Store, data: DataFrame, profile: CountryProfile, tag: str, version: str, init: datetime
) -> None:
    wanted = config_table(
        store.spark, [{"name": tag, "version": version}], schemas.FORECASTERS
    ).withColumn("name", derive_names("forecaster", F.col("name")))
    decided = upsert_forecaster(store.read("forecasters", schemas.FORECASTERS), wanted)
    created = decided.filter(F.col("action") != "reuse").drop("action")
    if not created.isEmpty():
        append_rows(created, store.path("forecasters"))
    if profile.country == "be":
        data = data.filter(F.col("region") == NATIONAL)
    values = save_forecast(data, store.locations(), profile, tag, version, init)
    append_forecast(newest_poll(values, FORECAST_KEY), store.path("forecast_values"), run=FORECAST_RUN)


def stored_sites(store: Store) -> DataFrame:
    """Newest version of each site."""
    versions = store.read("sites", f"{schemas.SITE_REGISTRY}, run_utc timestamp")
    columns = ("country", "latitude", "longitude", "capacity_kw")
    newest = versions.groupBy("client_site_name").agg(
        F.max_by(F.struct(*columns), F.col("run_utc")).alias("_site")
    )
    return newest.select("client_site_name", "_site.*")


def save_sites(store: Store, before: DataFrame, after: DataFrame, now: datetime) -> None:
    """Append the sites that are new or changed."""
    changed = after.join(before, ["client_site_name", "capacity_kw"], "left_anti")
    if not changed.isEmpty():
        stamp = F.lit(now.isoformat(sep=" ")).cast("timestamp")
        columns = ["client_site_name", "country", "latitude", "longitude", "capacity_kw"]
        append_rows(changed.select(*columns, stamp.alias("run_utc")), store.path("sites"))


def run_site_generation(store: Store, data: DataFrame, country: str, now: datetime) -> None:
    if country not in SITE_KEYS:
        raise ValueError(f"sites store generation of {sorted(SITE_KEYS)} only, not {country!r}")
    before = stored_sites(store)
    sites = site_table(store.spark, country, schemas.SITES)
    saved = site_generation(data, sites, before, SITE_KEYS[country], country)
    # only rows of the batch's own days can be the same; the feed's days are a superset that needs no join
    table = store.read("site_generation", schemas.SITE_GENERATION_STORED)
    stored = on_days(table, days_of(data, "target_datetime_utc"))
    fresh = drop_existing(newest_poll(saved.rows, SITE_KEY), stored, SITE_KEY)
    append_site_generation(fresh, store.path("site_generation"))
    save_sites(store, before, saved.sites, now)


def run_site_forecast(
    store: Store, data: DataFrame, country: str, tag: str, version: str, now: datetime
) -> None:
    if country != "nl":
        raise ValueError(f"sites store forecasts of 'nl' only, not {country!r}")
    before = stored_sites(store)
    national = site_table(store.spark, country, schemas.SITES).filter(
        F.col("client_site_name") == FORECAST_SITE
    )
    created = national.join(before, "client_site_name", "left_anti").select(
        "client_site_name",
        F.lit(country).alias("country"),
        "latitude",
        "longitude",
        F.lit(NL_SITE_CAPACITY_KW).cast("bigint").alias("capacity_kw"),
    )
    save_sites(store, before, created, now)
    rows = newest_poll(site_forecast(data, FORECAST_SITE, tag, version, now), SITE_FORECAST_KEY)
    append_forecast(rows, store.path("site_forecast_values"), "timestamp_utc", SITE_FORECAST_RUN)


def forecaster_tag(country: str, forecast_type: str) -> str:
    if country == "de":
        return f"entsoe-de-{forecast_type.replace('_', '-')}"
    if country not in FORECASTER_TAGS:
        raise ValueError(f"no forecaster for {country!r}")
    return FORECASTER_TAGS[country]


def run_app(
    run: FeedRun,
    country: str = "gb",
    kind: str = "generation",
    sink: str = "data-platform",
    store: str | None = None,
    out_dir: str | None = None,
    version: str = __version__,
) -> bool:
    """Read one feed and save it. False when there was nothing to save.

    Landed files are read once: the delivered rows are a table in the shared folder while the run lasts,
    and every check and sink reads that table.
    """
    if sink not in SINKS:
        raise ValueError(f"unknown sink {sink!r}, expected one of {SINKS}")
    with shared_table(feed_dispatch(country, kind, run), f"delivered-{country}") as data:
        return not data.isEmpty() and _save(run, data, country, kind, sink, store, out_dir, version)


def _save(
    run: FeedRun, data: DataFrame, country: str, kind: str, sink: str, store: str | None, out_dir: str | None,
    version: str,
) -> bool:
    now = as_utc(run.now)
    if sink == "csv":
        write_csv(data, out_dir)
        return True
    tables = Store(run.spark, store)
    if kind == "forecast":
        tag = forecaster_tag(country, run.forecast_type)
        if sink == "site-db":
            run_site_forecast(tables, data, country, tag, version, now)
        else:
            init = now.replace(minute=now.minute - now.minute % 30, second=0, microsecond=0)
            run_platform_forecast(tables, data, profile_for(country), tag, version, init)
    elif sink == "site-db":
        run_site_generation(tables, data, country, now)
    else:
        run_platform_generation(tables, data, profile_for(country))
        if country == "nl" and run.potential:
            variant = no_curtailment_variant(data)
            run_platform_generation(tables, variant, profile_for("nl_no_curtailment"))
    return True
