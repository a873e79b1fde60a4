"""Aggregations and newest-row operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from powerflow import operators as op
from powerflow.catalogue.columns import DE_REGION, DE_REGIONS
from powerflow.catalogue.inputs import (
    DAILY,
    FACTS,
    HOME,
    LOC,
    OBS,
    REG,
    REGION_IDS,
    daily,
    facts,
    observations,
    registry,
    table,
)
from powerflow.catalogue.registry import query
from powerflow.functions import kw_to_watts, lookup_map
from powerflow.settings import IND_ASSETS

DAILY_NAMES = {"ts": "day", "value": "capacity"}


@query(
    "seed_capacity",
    """SELECT gsp_id, CAST(trunc(coalesce(max(capacity_kw), max(solar_generation_kw)) * 1000) AS BIGINT)
              AS seed_watts FROM facts GROUP BY gsp_id""",
    OBS,
    LOC,
    FACTS,
)
def seed_capacity(spark, sf_dir):
    return op.seed_capacity(facts(spark, sf_dir), "gsp_id")


@query(
    "capacity_override",
    """SELECT gsp_id, CAST(trunc(max(capacity_kw)) AS BIGINT) AS capacity_override_kw
       FROM facts GROUP BY gsp_id""",
    OBS,
    LOC,
    FACTS,
)
def capacity_override(spark, sf_dir):
    """NULL where no capacity is published."""
    return op.capacity_override(facts(spark, sf_dir), "gsp_id")


@query(
    "max_generation_default",
    """SELECT event_id, max(solar_generation_kw) OVER (PARTITION BY gsp_id) AS capacity_kw,
              (SELECT max(solar_generation_kw) FROM facts) AS batch_capacity_kw FROM facts""",
    OBS,
    LOC,
    FACTS,
)
def max_generation_default(spark, sf_dir):
    """Capacity from the largest generation of the key, and of the whole batch."""
    rows = facts(spark, sf_dir).drop("capacity_kw")
    by_key = op.max_generation_default(rows, "gsp_id")
    whole = op.max_generation_default(by_key, capacity="batch_capacity_kw")
    return whole.select("event_id", "capacity_kw", "batch_capacity_kw")


@query(
    "max_over_key",
    "SELECT event_id, max(value) OVER (PARTITION BY user_id) AS max_value FROM events",
)
def max_over_key(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return op.max_over_key(rows, "user_id", "value").select("event_id", "max_value")


CAPACITIES = f"""capacities AS (
    SELECT {DE_REGION} AS region, ts AS year_start, CASE WHEN pct > 50 THEN value END AS Solar
    FROM (SELECT event_type, ts, power_mw AS value, pct FROM obs))"""


def capacities(spark, sf_dir):
    obs = observations(spark, sf_dir)
    return obs.select(
        lookup_map(F.col("event_type"), DE_REGIONS).alias("region"),
        F.col("ts").alias("year_start"),
        F.when(F.col("pct") > 50, F.col("power_mw")).alias("Solar"),
    )


@query(
    "latest_capacity",
    """SELECT region, arg_max(Solar, year_start) * 1000 AS capacity_kw FROM capacities
       WHERE Solar IS NOT NULL GROUP BY region""",
    OBS,
    CAPACITIES,
)
def latest_capacity(spark, sf_dir):
    return op.latest_capacity(capacities(spark, sf_dir), "region", "year_start")


@query(
    "latest_per_location",
    """SELECT event_id, user_id, ts FROM (SELECT *, row_number() OVER (
           PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def latest_per_location(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return op.latest_per_location(rows, "user_id", "ts", [F.col("event_id").desc()])


@query(
    "capacity_updates",
    """SELECT location_uuid, target_datetime_utc, new_watts FROM (
           SELECT *, row_number() OVER (PARTITION BY location_uuid
                  ORDER BY target_datetime_utc DESC, new_watts DESC) AS rn
           FROM (SELECT location_uuid, target_datetime_utc, effective_capacity_watts,
                        solar_generation_kw * 1000 AS new_watts, event_type
                 FROM facts JOIN reg USING (gsp_id)
                 WHERE c_mktsegment <> 'FURNITURE' AND solar_generation_kw <> 0)
           WHERE event_type <> 'error')
       WHERE rn = 1 AND abs(effective_capacity_watts - new_watts) >= 1""",
    OBS,
    LOC,
    FACTS,
    REG,
)
def capacity_updates(spark, sf_dir):
    """Newest reading per location taken as its capacity; "error" readings are not validated."""
    rows = facts(spark, sf_dir).withColumns(
        {
            "capacity_kw": F.col("solar_generation_kw"),
            "update_capacity": F.col("event_type") != "error",
        }
    )
    updates = op.capacity_updates(op.join_locations(rows, registry(spark, sf_dir), HOME))
    return updates.select(
        "location_uuid",
        "target_datetime_utc",
        F.col("new_effective_capacity_watts").alias("new_watts"),
    )


@query(
    "first_per_asset",
    """SELECT event_id, energy_type, power FROM (
           SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'solar' ELSE 'wind' END
                  AS energy_type, power_mw AS power FROM obs
           UNION ALL
           SELECT event_id, 'solar', CAST(pct AS DOUBLE) FROM obs
           WHERE event_type NOT IN ('view', 'click'))""",
    OBS,
)
def first_per_asset(spark, sf_dir):
    """First record of each asset in the order of a response."""
    obs = observations(spark, sf_dir)

    def record(name, power):
        return F.struct(name.alias("scada_name"), power.cast("double").alias("power"))

    solar = F.col("event_type").isin("view", "click")
    named = F.when(solar, "SOLAR GEN").otherwise("WIND GEN")
    records = F.array(
        record(F.lit("FREQUENCY"), F.lit(50.0)),
        record(named, F.col("power_mw")),
        record(F.lit("SOLAR GEN"), F.col("pct")),
    )
    responses = obs.select("event_id", records.alias("records"))
    return op.first_per_asset(responses, "records", IND_ASSETS).select(
        "event_id", "energy_type", "asset.power"
    )


COMPLETE = """complete AS (
    SELECT day, count(*) = 6 AND count(DISTINCT region_id) = 6 AND min(region_id) = 0
              AND max(region_id) = 5 AS is_complete,
           sum(CASE WHEN region_id <> 0 THEN capacity END) AS regional,
           max(CASE WHEN region_id = 0 THEN capacity END) AS national
    FROM daily WHERE capacity IS NOT NULL GROUP BY day)"""


@query("region_set_complete", "SELECT day, is_complete FROM complete", DAILY, COMPLETE)
def region_set_complete(spark, sf_dir):
    return op.region_set_complete(daily(spark, sf_dir), REGION_IDS, **DAILY_NAMES)


@query(
    "complete_timestamps",
    "SELECT day, region_id, capacity FROM daily JOIN complete USING (day) WHERE is_complete",
    DAILY,
    COMPLETE,
)
def complete_timestamps(spark, sf_dir):
    rows = op.complete_timestamps(daily(spark, sf_dir), REGION_IDS, **DAILY_NAMES)
    return rows.select("day", "region_id", "capacity")


@query(
    "regional_sum", "SELECT day, round(regional, 2) AS regional, national FROM complete",
    DAILY, COMPLETE,
)
def regional_sum(spark, sf_dir):
    sums = op.regional_sum(daily(spark, sf_dir), **DAILY_NAMES)
    return sums.withColumn("regional", F.round("regional", 2))


@query(
    "national_vs_regional",
    """SELECT day, coalesce(abs(regional - national) <= 0.001::DOUBLE * abs(national), false)
              AS is_close FROM complete""",
    DAILY,
    COMPLETE,
)
def national_vs_regional(spark, sf_dir):
    return op.national_vs_regional(daily(spark, sf_dir), **DAILY_NAMES).select("day", "is_close")


@query(
    "validate_capacity",
    """SELECT day, region_id, coalesce(is_complete
              AND abs(regional - national) <= 0.001::DOUBLE * abs(national), false) AS update_capacity
       FROM daily LEFT JOIN complete USING (day)""",
    DAILY,
    COMPLETE,
)
def validate_capacity(spark, sf_dir):
    checked = op.validate_capacity(daily(spark, sf_dir), REGION_IDS, **DAILY_NAMES)
    return checked.select("day", "region_id", "update_capacity")


@query(
    "collect_observations",
    """SELECT user_id, date_trunc('hour', ts) AS slot_start, CAST(0 AS INT) AS part,
              CAST(count(*) AS INT) AS n_values, CAST(sum(copies) AS BIGINT) AS n_rows,
              arg_min(watts, ts) AS first_watts,
              string_agg(CAST(watts AS VARCHAR), ',' ORDER BY ts, watts) AS watts
       FROM (SELECT user_id, ts, CAST(trunc(value * 1000) AS BIGINT) AS watts, count(*) AS copies
             FROM events GROUP BY ALL)
       GROUP BY ALL""",
)
def collect_observations(spark, sf_dir):
    """Ordered payloads per location and hour."""
    rows = table(spark, sf_dir, "events").select(
        "user_id", "ts", kw_to_watts(F.col("value")).alias("watts")
    )
    payloads = op.collect_observations(rows, ["user_id"], "ts", "watts")
    watts = F.transform("values", lambda v: v.getField("watts").cast("string"))
    copies = F.transform("values", lambda v: v.getField("copies"))
    total = F.aggregate(copies, F.lit(0).cast("bigint"), lambda a, b: a + b)
    return payloads.select(
        "user_id",
        "slot_start",
        "part",
        F.size("values").alias("n_values"),
        total.alias("n_rows"),
        F.element_at("values", 1).getField("watts").alias("first_watts"),
        F.array_join(watts, ",").alias("watts"),
    )


@query(
    "collect_observations_split",
    """SELECT user_id, date_trunc('hour', ts) AS slot_start, CAST(count(*) AS INT) AS n_values,
              CAST(sum(copies) AS BIGINT) AS n_rows
       FROM (SELECT user_id % 3 AS user_id, ts, CAST(trunc(value * 1000) AS BIGINT) AS watts, count(*) AS copies
             FROM events GROUP BY ALL)
       GROUP BY ALL""",
)
def collect_observations_split(spark, sf_dir):
    """Payloads of two values at most hold, put together, the same values."""
    rows = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 3).alias("user_id"), "ts", kw_to_watts(F.col("value")).alias("watts")
    )
    payloads = op.collect_observations(rows, ["user_id"], "ts", "watts", max_values=2)
    values = payloads.select("user_id", "slot_start", F.inline("values")).distinct()
    return values.groupBy("user_id", "slot_start").agg(
        F.count(F.lit(1)).cast("int").alias("n_values"), F.sum("copies").alias("n_rows")
    )


@query(
    "newest_poll",
    """SELECT user_id, event_type, day, event_id, value FROM (
           SELECT user_id, event_type, ts::DATE AS day, event_id, value, poll, ts FROM events, range(0, 2) t(poll)
           WHERE poll = 0 OR event_id % 3 = 0)
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY ts DESC, poll DESC, event_id DESC) = 1""",
)
def newest_poll(spark, sf_dir):
    """The last reading per location, kind and day out of two polls, the later one of a part of the rows."""
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")).drop("props")
    again = events.filter("event_id % 3 = 0").withColumn("poll", F.lit(1))
    polls = events.withColumn("poll", F.lit(0)).union(again)
    newest = op.newest_poll(polls, ["user_id", "event_type", "day"], ["ts", "poll"])
    return newest.select("user_id", "event_type", "day", "event_id", "value")


@query(
    "time_extent",
    """SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, max(event_id) AS last_update
       FROM events GROUP BY user_id""",
)
def time_extent(spark, sf_dir):
    return op.time_extent(table(spark, sf_dir, "events"), "ts", "user_id", "event_id")


@query(
    "distinct_keys",
    "SELECT user_id, event_type, count(*) AS n_rows FROM events GROUP BY ALL",
)
def distinct_keys(spark, sf_dir):
    return op.distinct_keys(table(spark, sf_dir, "events"), ["user_id", "event_type"])


@query(
    "run_summary",
    """SELECT event_type, count(*) AS n_rows, count(value) AS n_values, round(sum(value), 4) AS total,
              count(DISTINCT ts) AS n_timestamps, min(ts) AS first_ts, max(ts) AS last_ts
       FROM events GROUP BY event_type""",
)
def run_summary(spark, sf_dir):
    summary = op.run_summary(table(spark, sf_dir, "events"), "event_type", "ts", "value")
    return summary.withColumn("total", F.round("total", 4))


TYPES = ["click", "error", "purchase", "signup", "view"]
PIVOTED = ", ".join(f"round(sum(value) FILTER (event_type = '{t}'), 4) AS {t}" for t in TYPES)


@query(
    "pivot_cube",
    f"SELECT date_trunc('day', ts)::TIMESTAMP AS day, {PIVOTED} FROM events GROUP BY ALL",
)
def pivot_cube(spark, sf_dir):
    """Days by kind of reading."""
    days = table(spark, sf_dir, "events").select(
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "event_type", "value"
    )
    cube = op.pivot_cube(days, "day", "event_type", ["value"], TYPES, agg=F.sum)
    return cube.withColumns({name: F.round(name, 4) for name in TYPES})
