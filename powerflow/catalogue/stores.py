"""Observation store, site store, dimensions, cubes and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from powerflow import operators as op
from powerflow import plans, sinks
from powerflow.catalogue.inputs import (
    FACTS,
    HOME,
    LOC,
    OBS,
    REG,
    facts,
    locations,
    observations,
    registry,
    stored_observations,
    table,
)
from powerflow.catalogue.registry import query
from powerflow.catalogue.totals import TYPES
from powerflow.functions import metadata_value, string_tag, tagged_map
from powerflow.session import shared_folder
from powerflow.settings import CountryProfile
from powerflow.sources import days_of, on_days, read_table, time_window

# Facts joined to the registry, and what of them is worth storing.
JOINED = """joined AS (
    SELECT location_uuid, 'SOLAR' AS energy_source, 'pvlive_' || replace(regime, '-', '_') AS observer_name,
           target_datetime_utc AS timestamp_utc, solar_generation_kw, capacity_kw,
           effective_capacity_watts, capacity_kw * 1000 AS new_watts, reg.gsp_id
    FROM facts JOIN reg USING (gsp_id)
    WHERE c_mktsegment <> 'FURNITURE' AND (capacity_kw IS NULL OR capacity_kw <> 0)),
    fresh AS (
    SELECT location_uuid, energy_source, observer_name, timestamp_utc,
           CAST(trunc(solar_generation_kw * 1000) AS BIGINT) AS value_watts
    FROM joined WHERE NOT coalesce(solar_generation_kw > capacity_kw * 1.09::DOUBLE, false))"""

# Of several values for one key the largest is stored.
ONCE = """once AS (SELECT location_uuid, energy_source, observer_name, timestamp_utc,
        max(value_watts) AS value_watts FROM fresh GROUP BY ALL)"""

OBSERVATION = ("location_uuid", "energy_source", "observer_name", "timestamp_utc", "value_watts")


@query(
    "save_generation",
    """SELECT * FROM once f WHERE NOT EXISTS (
           SELECT 1 FROM facts s WHERE s.solar_generation_kw > 5000
              AND 'loc-' || s.gsp_id = f.location_uuid AND s.target_datetime_utc = f.timestamp_utc
              AND 'pvlive_' || replace(s.regime, '-', '_') = f.observer_name)""",
    OBS,
    LOC,
    FACTS,
    REG,
    JOINED,
    ONCE,
)
def save_generation(spark, sf_dir):
    """New observations of a batch: known locations, plausible, not stored before."""
    saved = plans.save_generation(
        facts(spark, sf_dir), registry(spark, sf_dir), stored_observations(spark, sf_dir), HOME
    )
    return saved.observations


@query(
    "capacity_history",
    """SELECT location_uuid, energy_source, CAST(trunc(new_watts) AS BIGINT) AS new_effective_capacity_watts,
              timestamp_utc AS valid_from_utc, CAST(gsp_id AS DOUBLE) AS gsp_id,
              trunc(solar_generation_kw) AS undegraded
       FROM (SELECT *, row_number() OVER (PARTITION BY location_uuid
                    ORDER BY timestamp_utc DESC, new_watts DESC) AS rn
             FROM (SELECT * REPLACE (effective_capacity_watts / 2 AS effective_capacity_watts)
                   FROM joined) WHERE new_watts IS NOT NULL)
       WHERE rn = 1 AND abs(effective_capacity_watts - new_watts) >= 1""",
    OBS,
    LOC,
    FACTS,
    REG,
    JOINED,
)
def capacity_history(spark, sf_dir):
    """History rows when the registry holds half of the published capacity."""
    halved = registry(spark, sf_dir).withColumn(
        "effective_capacity_watts", F.col("effective_capacity_watts") / 2
    )
    rows = facts(spark, sf_dir).withColumn(
        "capacity_no_degradation_kw", F.col("solar_generation_kw")
    )
    saved = plans.save_generation(rows, halved, stored_observations(spark, sf_dir), HOME)
    number = metadata_value(F.col("metadata"), "gsp_id", "number")
    undegraded = metadata_value(F.col("metadata"), "capacity_no_degradation_kw", "number")
    return saved.capacity.select(
        "location_uuid",
        "energy_source",
        "new_effective_capacity_watts",
        "valid_from_utc",
        number.alias("gsp_id"),
        undegraded.alias("undegraded"),
    )


NATIONAL = """national AS (
    SELECT 'loc-' || c_custkey AS location_uuid, c_acctbal * 1000000 AS watts FROM customer
    WHERE c_acctbal > 0 AND c_mktsegment <> 'FURNITURE' ORDER BY c_name LIMIT 1)"""
RUN = CountryProfile("home", "gsp_id", "number", None)


@query(
    "save_forecast",
    """SELECT 'neso_solar_forecast' AS forecaster_name, '1.0' AS forecaster_version, location_uuid,
              'SOLAR' AS energy_source, TIMESTAMP '2024-01-10 12:00:00' AS init_time_utc,
              CAST(trunc(minutes) AS INT) AS horizon_mins,
              solar_generation_kw * 1000 / watts AS p50_fraction
       FROM (SELECT *, (epoch_us(target_datetime_utc) - epoch_us(TIMESTAMP '2024-01-10 12:00:00'))
                       / 60000000.0::DOUBLE AS minutes FROM facts), national
       WHERE trunc(minutes) >= 0""",
    OBS,
    LOC,
    FACTS,
    NATIONAL,
)
def save_forecast(spark, sf_dir):
    """Values of one forecast run for the first national location with capacity."""
    nations = (
        registry(spark, sf_dir)
        .filter(F.col("effective_capacity_watts") > 0)
        .filter(metadata_value(F.col("metadata"), "gsp_id", "number").isNotNull())
        .withColumns(
            {
                "location_type": F.lit("NATION"),
                "metadata": tagged_map(country=string_tag(F.lit("home"))),
            }
        )
    )
    return plans.save_forecast(
        facts(spark, sf_dir), nations, RUN, "neso-solar-forecast", "1.0", "2024-01-10 12:00:00"
    )


# Sites: one per nation; those of the first three regions are stored with a fixed capacity.
SITE_ROWS = """site_rows AS (
    SELECT solar_generation_kw, target_datetime_utc, capacity_kw, c_nationkey AS region_id
    FROM facts JOIN loc ON gsp_id = location_id)"""


def site_inputs(spark, sf_dir):
    loc = locations(spark, sf_dir).select(F.col("location_id").alias("gsp_id"), "c_nationkey")
    rows = facts(spark, sf_dir).join(loc, "gsp_id").select(
        "solar_generation_kw",
        "target_datetime_utc",
        "capacity_kw",
        F.col("c_nationkey").alias("region_id"),
    )
    nations = table(spark, sf_dir, "nation")
    sites = nations.select(
        F.col("n_nationkey").cast("string").alias("site_key"),
        F.col("n_name").alias("client_site_name"),
        F.col("n_regionkey").cast("double").alias("latitude"),
        F.col("n_nationkey").cast("double").alias("longitude"),
    )
    stored = nations.filter("n_regionkey < 3").select(
        F.col("n_name").alias("client_site_name"),
        F.lit("nl").alias("country"),
        F.col("n_regionkey").cast("double").alias("latitude"),
        F.col("n_nationkey").cast("double").alias("longitude"),
        F.lit(5_000_000).cast("bigint").alias("capacity_kw"),
    )
    return rows, sites, stored


@query(
    "site_generation",
    """SELECT solar_generation_kw AS power_kw, target_datetime_utc AS start_utc, 'solar' AS energy_type,
              n_name AS client_site_name
       FROM site_rows JOIN nation ON region_id = n_nationkey""",
    OBS,
    LOC,
    FACTS,
    SITE_ROWS,
)
def site_generation(spark, sf_dir):
    """Rows routed to their sites."""
    rows, sites, stored = site_inputs(spark, sf_dir)
    return plans.site_generation(rows, sites, stored, "region_id", "nl").rows


OVERRIDES = """overrides AS (
    SELECT n_name, CAST(trunc(max(capacity_kw)) AS BIGINT) AS override_kw
    FROM site_rows JOIN nation ON region_id = n_nationkey GROUP BY n_name)"""


@query(
    "site_registry",
    """SELECT n_name AS client_site_name, 'nl' AS country, CAST(n_regionkey AS DOUBLE) AS latitude,
              CAST(n_nationkey AS DOUBLE) AS longitude,
              coalesce(override_kw, CASE WHEN n_regionkey < 3 THEN 5000000 ELSE 20000000 END)
              AS capacity_kw
       FROM nation LEFT JOIN overrides USING (n_name)
       WHERE n_regionkey < 3 OR n_name IN (SELECT n_name FROM overrides)""",
    OBS,
    LOC,
    FACTS,
    SITE_ROWS,
    OVERRIDES,
)
def site_registry(spark, sf_dir):
    """Sites after the batch: created where missing, capacity refreshed."""
    rows, sites, stored = site_inputs(spark, sf_dir)
    return plans.site_generation(rows, sites, stored, "region_id", "nl").sites


@query(
    "site_forecast",
    """SELECT solar_generation_kw AS forecast_power_kw, target_datetime_utc AS start_utc,
              target_datetime_utc + INTERVAL 15 MINUTE AS end_utc,
              (epoch_us(target_datetime_utc) - epoch_us(TIMESTAMP '2024-01-10 12:15:00'))
                  / 60000000.0::DOUBLE AS horizon_minutes,
              'nl_national' AS client_site_name, TIMESTAMP '2024-01-10 12:15:00' AS timestamp_utc,
              'ned-nl-national' AS ml_model_name, '1.0' AS forecast_version
       FROM facts""",
    OBS,
    LOC,
    FACTS,
)
def site_forecast(spark, sf_dir):
    return plans.site_forecast(
        facts(spark, sf_dir), "nl_national", "ned-nl-national", "1.0", "2024-01-10 12:29:59"
    )


# Known and wanted members: customers stand for sites, those with a positive balance are stored.
@query(
    "get_or_create_site",
    """SELECT c_name AS client_site_name, 'nl' AS country, CAST(c_nationkey AS DOUBLE) AS latitude,
              CAST(c_custkey AS DOUBLE) AS longitude,
              CASE WHEN c_acctbal > 5000 THEN 7
                   WHEN c_mktsegment = 'BUILDING' THEN 20000000 ELSE c_custkey END AS capacity_kw
       FROM customer""",
)
def get_or_create_site(spark, sf_dir):
    """Stored sites stay, missing ones get their override or the country's default."""
    customers = table(spark, sf_dir, "customer")
    site = [
        F.col("c_name").alias("client_site_name"),
        F.col("c_nationkey").cast("double").alias("latitude"),
        F.col("c_custkey").cast("double").alias("longitude"),
    ]
    stored = customers.filter("c_acctbal > 5000").select(
        *site, F.lit("nl").alias("country"), F.lit(7).cast("bigint").alias("capacity_kw")
    )
    override = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey"))
    wanted = customers.select(*site, override.alias("capacity_override_kw"))
    return op.get_or_create_site(stored, wanted, "nl")


@query(
    "update_site_capacity",
    """SELECT c_name AS client_site_name,
              CASE WHEN abs(n.override_kw - trunc(c_acctbal)) >= 1 THEN n.override_kw
                   ELSE CAST(trunc(c_acctbal) AS BIGINT) END AS capacity_kw,
              coalesce(abs(n.override_kw - trunc(c_acctbal)) >= 1, false) AS is_updated
       FROM customer LEFT JOIN (
           SELECT o_custkey, CAST(trunc(max(o_totalprice)) AS BIGINT) AS override_kw
           FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) n ON c_custkey = o_custkey""",
)
def update_site_capacity(spark, sf_dir):
    """Capacities replaced by the largest finished order, up or down."""
    customers = table(spark, sf_dir, "customer")
    stored = customers.select(
        F.col("c_name").alias("client_site_name"),
        F.col("c_acctbal").cast("bigint").alias("capacity_kw"),
    )
    largest = (
        table(spark, sf_dir, "orders")
        .filter("o_orderstatus = 'F'")
        .groupBy("o_custkey")
        .agg(F.max("o_totalprice").cast("bigint").alias("capacity_override_kw"))
    )
    overrides = customers.join(largest, F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("c_name").alias("client_site_name"), "capacity_override_kw"
    )
    return op.update_site_capacity(stored, overrides)


@query(
    "upsert_forecaster",
    """SELECT c_name AS name, CAST(c_nationkey AS VARCHAR) AS version,
              CASE WHEN c_acctbal <= 0 THEN 'create' WHEN c_nationkey = 3 THEN 'reuse'
                   ELSE 'new_version' END AS action
       FROM customer""",
)
def upsert_forecaster(spark, sf_dir):
    """Customers with a positive balance are stored with version 3."""
    customers = table(spark, sf_dir, "customer")
    stored = customers.filter("c_acctbal > 0").select(
        F.col("c_name").alias("name"), F.lit("3").alias("version")
    )
    wanted = customers.select(
        F.col("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("version")
    )
    return op.upsert_forecaster(stored, wanted)


@query(
    "seed_locations",
    """SELECT c_name AS location_name,
              CASE WHEN c_mktsegment = 'BUILDING' THEN 'WIND' ELSE 'SOLAR' END AS energy_source,
              CASE WHEN c_nationkey = 0 THEN 'NATION' ELSE 'STATE' END AS location_type,
              'POINT(' || CAST(c_acctbal AS VARCHAR) || ' ' || CAST(c_acctbal / 2 AS VARCHAR) || ')'
                  AS geometry_wkt,
              CAST(coalesce(seed_watts, 100000000) AS DOUBLE) AS effective_capacity_watts,
              'nl' AS country, CAST(c_custkey AS DOUBLE) AS region_id,
              TIMESTAMP '2020-01-01 00:00:00' AS valid_from_utc
       FROM customer LEFT JOIN (
           SELECT gsp_id, CAST(trunc(coalesce(max(capacity_kw), max(solar_generation_kw)) * 1000) AS BIGINT)
                  AS seed_watts FROM facts GROUP BY gsp_id) ON gsp_id = c_custkey""",
    OBS,
    LOC,
    FACTS,
)
def seed_locations(spark, sf_dir):
    """Registry rows with capacities taken from the incoming facts."""
    known = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        (F.col("c_acctbal") / 2).alias("latitude"),
        F.col("c_acctbal").alias("longitude"),
        F.col("c_custkey").alias("region_id"),
        F.when(F.col("c_nationkey") == 0, "NATION").otherwise("STATE").alias("location_type"),
        F.when(F.col("c_mktsegment") == "BUILDING", "wind").alias("energy_source"),
    )
    rows = facts(spark, sf_dir).withColumnRenamed("gsp_id", "region_id")
    seeds = op.seed_capacity(rows, "region_id")
    made = op.seed_locations(known, seeds, CountryProfile("nl", "region_id", "number", "nednl"))
    tags = F.col("metadata")
    return made.select(
        "location_name",
        "energy_source",
        "location_type",
        "geometry_wkt",
        "effective_capacity_watts",
        metadata_value(tags, "country", "string").alias("country"),
        metadata_value(tags, "region_id", "number").alias("region_id"),
        "valid_from_utc",
    )


PER_DAY = ", ".join(
    f"CAST(CAST(max(value) FILTER (event_type = '{t}') AS FLOAT) AS DOUBLE) AS {t}_generation_mw, "
    f"CAST(CAST(max(pct) FILTER (event_type = '{t}') AS FLOAT) AS DOUBLE) AS {t}_capacity_mwp"
    for t in TYPES
)


@query(
    "backfill_regional_cube",
    f"""SELECT date_trunc('day', ts)::TIMESTAMP AS time_utc, {PER_DAY}
        FROM (SELECT ts, event_type, power_mw AS value, pct FROM obs)
        WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-29' GROUP BY ALL""",
    OBS,
)
def backfill_regional_cube(spark, sf_dir):
    """Days by region as 32-bit values, widened again for the comparison."""
    cube = plans.backfill_regional_cube(
        daily_largest(spark, sf_dir), "2024-01-02", "2024-01-29", TYPES
    )
    wide = [name for name in cube.columns if name != "time_utc"]
    return cube.withColumns({name: F.col(name).cast("double") for name in wide})


def daily_largest(spark, sf_dir):
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("datetime")
    return (
        observations(spark, sf_dir)
        .groupBy(day, F.col("event_type").alias("region"))
        .agg(F.max("power_mw").alias("measured"), F.max("pct").alias("monitoredcapacity"))
    )


@query(
    "backfill_gsp_cube",
    f"""SELECT date_trunc('day', ts)::TIMESTAMP AS time_utc,
               {", ".join(f"max(power_mw) FILTER (event_type = '{t}') AS {t}_generation_mw, "
                          f"max(pct) FILTER (event_type = '{t}') AS {t}_capacity_mwp" for t in TYPES)}
        FROM obs GROUP BY ALL""",
    OBS,
)
def backfill_gsp_cube(spark, sf_dir):
    """Complete days by area, after the checks of ids, duplicates and missing times."""
    rows = daily_largest(spark, sf_dir).select(
        F.col("datetime").alias("datetime_gmt"),
        F.col("region").alias("gsp_id"),
        F.col("measured").alias("generation_mw"),
        F.col("monitoredcapacity").alias("capacity_mwp"),
    )
    ids = rows.select("gsp_id").distinct()
    return plans.backfill_gsp_cube(
        rows, ids, ids, "2024-01-01", "2024-01-30", step="1 DAY"
    )


@query(
    "write_csv",
    "SELECT event_id, user_id, event_type, value FROM events",
)
def write_csv(spark, sf_dir):
    """Written as CSV and read back."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    extra = rows.withColumn("_sa_instance_state", F.lit("object"))
    path = sinks.write_csv(extra, shared_folder(spark, "csv"), ["event_id"])
    schema = "event_id bigint, user_id bigint, event_type string, value double"
    return spark.read.schema(schema).option("header", True).csv(path)


@query(
    "append_observations",
    """SELECT location_uuid, energy_source, observer_name, timestamp_utc, value_watts,
              timestamp_utc::DATE AS date FROM once""",
    OBS,
    LOC,
    FACTS,
    REG,
    JOINED,
    ONCE,
)
def append_observations(spark, sf_dir):
    """Two batches, the later one overlapping the first, into one partitioned table."""
    path = shared_folder(spark, "observations")
    reg = registry(spark, sf_dir)
    rows = facts(spark, sf_dir)
    nothing = stored_observations(spark, sf_dir).limit(0)
    first = time_window(rows, "target_datetime_utc", "2024-01-01", "2024-01-20")
    early = plans.save_generation(first, reg, nothing, HOME)
    sinks.append_observations(early.observations, path)
    late = plans.save_generation(rows, reg, spark.read.parquet(path), HOME)
    sinks.append_observations(late.observations, path)
    stored = spark.read.parquet(path)
    return stored.select(*OBSERVATION, F.col("date").cast("date").alias("date"))


@query(
    "append_forecast",
    """SELECT solar_generation_kw AS forecast_power_kw, target_datetime_utc AS start_utc,
              day AS init_date, '1' || CASE WHEN day = DATE '2024-01-10' THEN '' ELSE '.1' END AS forecast_version
       FROM facts, (VALUES (DATE '2024-01-10'), (DATE '2024-01-11')) runs(day)
       WHERE day = DATE '2024-01-10' OR event_type <> 'view'""",
    OBS,
    LOC,
    FACTS,
)
def append_forecast(spark, sf_dir):
    """Two forecast runs; the first is repeated, and so is the second, with fewer values that replace it."""
    path = shared_folder(spark, "forecasts")
    rows = facts(spark, sf_dir)
    fewer = rows.filter("event_type <> 'view'")
    for data, version, run in [
        (rows, "1", "2024-01-10 12:00:00"), (rows, "1.1", "2024-01-11 12:00:00"),
        (rows, "1", "2024-01-10 12:00:00"), (fewer, "1.1", "2024-01-11 12:00:00"),
    ]:
        values = plans.site_forecast(data, "nl_national", "ned-nl-national", version, run)
        sinks.append_forecast(values, path, "timestamp_utc", ["forecast_version"])
    return spark.read.parquet(path).select("forecast_power_kw", "start_utc", "init_date", "forecast_version")


@query(
    "append_site_generation",
    """SELECT solar_generation_kw AS power_kw, target_datetime_utc AS start_utc, c_nationkey AS site_id,
              target_datetime_utc::DATE AS date
       FROM facts JOIN loc ON gsp_id = location_id
       QUALIFY row_number() OVER (PARTITION BY c_nationkey, target_datetime_utc ORDER BY solar_generation_kw DESC) = 1""",
    OBS,
    LOC,
    FACTS,
)
def append_site_generation(spark, sf_dir):
    """Three overlapping batches, the last with late rows; each reads the stored days of its own rows only."""
    path = shared_folder(spark, "site-generation")
    loc = locations(spark, sf_dir).select(F.col("location_id").alias("gsp_id"), F.col("c_nationkey").alias("site_id"))
    rows = facts(spark, sf_dir).join(loc, "gsp_id").select(
        F.col("solar_generation_kw").alias("power_kw"), F.col("target_datetime_utc").alias("start_utc"), "site_id"
    )
    key = ["site_id", "start_utc"]
    schema = "power_kw double, start_utc timestamp_ntz, site_id int, date date"
    for start, end in [("2024-01-05", "2024-01-15"), ("2024-01-10", "2024-02-15"), ("2023-12-31", "2024-02-15")]:
        batch = op.newest_poll(time_window(rows, "start_utc", start, end), key)
        stored = on_days(read_table(spark, path, schema), days_of(batch, "start_utc"))
        sinks.append_site_generation(op.drop_existing(batch, stored, key), path)
    return spark.read.schema(schema).parquet(path)


@query(
    "write_cube",
    f"""SELECT date_trunc('hour', ts) AS hour,
               {", ".join(f"max(value) FILTER (event_type = '{t}') AS {t}" for t in TYPES)}
        FROM events GROUP BY ALL""",
)
def write_cube(spark, sf_dir):
    """An hourly cube written in time order and read back."""
    hours = table(spark, sf_dir, "events").select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_type", "value"
    )
    cube = op.pivot_cube(hours, "hour", "event_type", ["value"], TYPES, agg=F.max)
    path = shared_folder(spark, "cube")
    sinks.write_cube(cube, path, "hour", overwrite=True)
    return spark.read.parquet(path)
