"""Filters, predicates and quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from powerflow import operators as op
from powerflow.catalogue.inputs import (
    FACTS,
    HOME,
    LOC,
    OBS,
    PRICES,
    RAW_GSP,
    REG,
    facts,
    observations,
    prices,
    raw_gsp,
    registry,
    table,
)
from powerflow.catalogue.registry import query
from powerflow.functions import metadata_value, number_tag, string_tag, tagged_map
from powerflow.operators.matching import country_isolation as isolate
from powerflow.sources import time_window as window


@query(
    "drop_incomplete",
    """SELECT event_id, gsp_id, capacity_kw FROM facts WHERE capacity_kw IS NOT NULL""",
    OBS,
    LOC,
    FACTS,
)
def drop_incomplete(spark, sf_dir):
    rows = facts(spark, sf_dir).select("event_id", "gsp_id", "capacity_kw")
    return op.drop_incomplete(rows, ["gsp_id", "capacity_kw"])


@query(
    "time_window",
    """SELECT event_id, ts FROM events
       WHERE ts >= TIMESTAMP '2024-01-02 10:30:00' AND ts <= TIMESTAMP '2024-01-29 21:00:00'""",
)
def time_window(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "ts")
    return window(rows, "ts", "2024-01-02T10:30:00", "2024-01-29T22:00:00+01:00")


@query(
    "drop_null_unless_all_null",
    """SELECT event_id, gsp_id, generation_mw FROM (
           SELECT *, count(generation_mw) OVER (PARTITION BY gsp_id) AS known FROM raw_gsp)
       WHERE generation_mw IS NOT NULL OR known = 0""",
    OBS,
    LOC,
    RAW_GSP,
)
def drop_null_unless_all_null(spark, sf_dir):
    rows = raw_gsp(spark, sf_dir).select("event_id", "gsp_id", "generation_mw")
    return op.drop_null_unless_all_null(rows, "gsp_id")


@query(
    "zero_gen_when_no_capacity",
    """SELECT event_id, gsp_id, CASE WHEN coalesce(sum(capacity_mwp) OVER (PARTITION BY gsp_id), 0) = 0
              THEN 0 ELSE generation_mw END AS generation_mw FROM raw_gsp""",
    OBS,
    LOC,
    RAW_GSP,
)
def zero_gen_when_no_capacity(spark, sf_dir):
    rows = raw_gsp(spark, sf_dir).select("event_id", "gsp_id", "generation_mw", "capacity_mwp")
    return op.zero_gen_when_no_capacity(rows, "gsp_id").drop("capacity_mwp")


@query(
    "partition_flags",
    """SELECT event_id, gsp_id, coalesce(sum(capacity_mwp) OVER w, 0) = 0 AS no_capacity,
              count(generation_mw) OVER w = 0 AS no_generation
       FROM raw_gsp WINDOW w AS (PARTITION BY gsp_id)""",
    OBS,
    LOC,
    RAW_GSP,
)
def partition_flags(spark, sf_dir):
    rows = raw_gsp(spark, sf_dir).select("event_id", "gsp_id", "generation_mw", "capacity_mwp")
    flagged = op.partition_flags(rows, "gsp_id", "generation_mw", "capacity_mwp")
    return flagged.drop("generation_mw", "capacity_mwp")


SETTLING = """settling AS (
    SELECT event_id, location_id, ts::DATE AS request_date, ts AS validto,
           ts + to_minutes(pct) AS lastupdate FROM obs)"""


def settling(spark, sf_dir):
    minutes = F.make_dt_interval(mins=F.col("pct"))
    return observations(spark, sf_dir).select(
        "event_id",
        "location_id",
        F.to_date("ts").alias("request_date"),
        F.col("ts").alias("validto"),
        (F.col("ts") + minutes).alias("lastupdate"),
    )


@query(
    "trim_unsettled",
    """SELECT event_id, location_id, validto FROM (
           SELECT *, max(lastupdate) OVER (PARTITION BY request_date, location_id) AS latest
           FROM settling) WHERE validto < latest - INTERVAL 15 MINUTE""",
    OBS,
    SETTLING,
)
def trim_unsettled(spark, sf_dir):
    rows = op.trim_unsettled(settling(spark, sf_dir), ["request_date", "location_id"])
    return rows.select("event_id", "location_id", "validto")


@query(
    "batch_max",
    """SELECT event_id, max(lastupdate) OVER (PARTITION BY request_date, location_id) AS batch_max
       FROM settling""",
    OBS,
    SETTLING,
)
def batch_max(spark, sf_dir):
    rows = op.batch_max(settling(spark, sf_dir), ["request_date", "location_id"], "lastupdate")
    return rows.select("event_id", "batch_max")


@query("drop_negative_power", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0")
def drop_negative_power(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return op.drop_negative_power(rows, "c_acctbal")


@query(
    "drop_zero_capacity",
    """SELECT event_id, capacity_kw FROM facts WHERE capacity_kw IS NULL OR capacity_kw <> 0""",
    OBS,
    LOC,
    FACTS,
)
def drop_zero_capacity(spark, sf_dir):
    rows = facts(spark, sf_dir).select("event_id", "capacity_kw")
    return op.drop_zero_capacity(rows)


@query(
    "drop_over_capacity",
    """SELECT event_id, solar_generation_kw, capacity_kw FROM facts
       WHERE NOT coalesce(solar_generation_kw > capacity_kw * 1.09::DOUBLE, false)""",
    OBS,
    LOC,
    FACTS,
)
def drop_over_capacity(spark, sf_dir):
    rows = facts(spark, sf_dir).select("event_id", "solar_generation_kw", "capacity_kw")
    return op.drop_over_capacity(rows)


@query(
    "flag_small_percentage",
    """SELECT event_id, NOT coalesce(NULLIF(pct, 50) / 1000.0::DOUBLE < 0.01::DOUBLE, false)
              AS update_capacity FROM obs""",
    OBS,
)
def flag_small_percentage(spark, sf_dir):
    """True where the percentage is unknown."""
    share = F.nullif(F.col("pct"), F.lit(50)) / 1000.0
    rows = observations(spark, sf_dir).select("event_id", share.alias("percentage"))
    return op.flag_small_percentage(rows).drop("percentage")


@query(
    "country_isolation",
    """SELECT c_custkey, coalesce(n_name, 'home') AS country FROM customer
       LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 0) ON c_nationkey = n_nationkey
       WHERE coalesce(n_name, 'NATION_1') = 'NATION_1'""",
)
def country_isolation(spark, sf_dir):
    """The home country also owns the locations without a country."""
    nations = table(spark, sf_dir, "nation").filter("n_nationkey <> 0")
    known = table(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    named = tagged_map(country=string_tag(F.col("n_name")))
    nameless = tagged_map(gsp_id=number_tag(F.col("c_custkey")))
    tags = F.when(F.col("n_name").isNull(), nameless).otherwise(named)
    own = isolate(known.select("c_custkey", tags.alias("metadata")), "NATION_1", home="NATION_1")
    country = metadata_value(F.col("metadata"), "country", "string")
    return own.select("c_custkey", F.coalesce(country, F.lit("home")).alias("country"))


@query(
    "has_metadata_key",
    "SELECT 'loc-' || c_custkey AS location_uuid FROM customer WHERE c_mktsegment <> 'FURNITURE'",
)
def has_metadata_key(spark, sf_dir):
    return op.has_metadata_key(registry(spark, sf_dir), "gsp_id").select("location_uuid")


@query(
    "flag_stale",
    """SELECT event_id, event_type = 'error' AND ts < TIMESTAMP '2024-01-20 11:00:00' AS is_stale
       FROM events""",
)
def flag_stale(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    only = F.col("event_type") == "error"
    return op.flag_stale(rows, "2024-01-20 12:00:00", "1 HOUR", only, "ts").select(
        "event_id", "is_stale"
    )


@query(
    "reject_null_prices",
    """SELECT segment, ts_hour, eur FROM (
           SELECT 'complete' AS segment, ts_hour, eur FROM prices
           WHERE NOT (SELECT bool_or(eur IS NULL) FROM prices)
           UNION ALL
           SELECT 'with gaps', ts_hour, NULLIF(eur, abs(eur)) FROM prices
           WHERE NOT (SELECT bool_or(NULLIF(eur, abs(eur)) IS NULL) FROM prices))""",
    PRICES,
)
def reject_null_prices(spark, sf_dir):
    """A complete price set passes, one with gaps is refused as a whole."""
    complete = prices(spark, sf_dir)
    positive = F.col("eur") >= 0
    gaps = complete.withColumn("eur", F.when(~positive, F.col("eur")))
    return op.union_feeds(
        op.reject_null_prices(complete, "eur").withColumn("segment", F.lit("complete")),
        op.reject_null_prices(gaps, "eur").withColumn("segment", F.lit("with gaps")),
    )


@query(
    "duplicate_timestamps",
    """SELECT gsp_id, datetime_gmt, count(*) AS n_rows FROM raw_gsp GROUP BY ALL
       HAVING count(*) > 1""",
    OBS,
    LOC,
    RAW_GSP,
)
def duplicate_timestamps(spark, sf_dir):
    return op.duplicate_timestamps(raw_gsp(spark, sf_dir), ["gsp_id", "datetime_gmt"])


@query(
    "grid_completeness",
    """SELECT user_id, day FROM (SELECT DISTINCT user_id FROM events),
              (SELECT TIMESTAMP '2024-01-01' + to_days(CAST(i AS INT)) AS day FROM range(0, 30) t(i))
       EXCEPT SELECT user_id, date_trunc('day', ts)::TIMESTAMP FROM events""",
)
def grid_completeness(spark, sf_dir):
    """Days on which a location that reports at all has no reading."""
    events = table(spark, sf_dir, "events")
    days = events.select("user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"))
    ids = events.select("user_id").distinct()
    return op.grid_completeness(days, ids, "2024-01-01", "2024-01-30", "1 DAY", "day")


@query(
    "route_by_key",
    """SELECT event_id, value, 'site-' || event_type AS client_site_name FROM events
        WHERE event_type IN ('view', 'click', 'error')""",
)
def route_by_key(spark, sf_dir):
    """Rows of the known sites in one pass; readings of other kinds belong to no site."""
    sites = known_sites(spark, sf_dir)
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return op.route_by_key(rows, sites, "event_type").drop("event_type")


def known_sites(spark, sf_dir):
    kinds = ["view", "click", "error"]
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type").isin(kinds))
        .select(
            F.col("event_type").alias("site_key"),
            F.concat(F.lit("site-"), "event_type").alias("client_site_name"),
        )
        .distinct()
    )


@query(
    "join_locations",
    """SELECT event_id, location_uuid, capacity_kw, effective_capacity_watts,
              capacity_kw * 1000 AS new_effective_capacity_watts
       FROM facts JOIN reg USING (gsp_id)
       WHERE c_mktsegment <> 'FURNITURE' AND (capacity_kw IS NULL OR capacity_kw <> 0)""",
    OBS,
    LOC,
    FACTS,
    REG,
)
def join_locations(spark, sf_dir):
    joined = op.join_locations(facts(spark, sf_dir), registry(spark, sf_dir), HOME)
    return joined.select(
        "event_id",
        "location_uuid",
        "capacity_kw",
        "effective_capacity_watts",
        "new_effective_capacity_watts",
    )


@query(
    "settle_areas",
    """SELECT event_id, gsp_id, CASE WHEN no_capacity THEN 0 ELSE generation_mw END AS generation_mw
       FROM (SELECT *, coalesce(sum(capacity_mwp) OVER w, 0) = 0 AS no_capacity,
                    count(generation_mw) OVER w = 0 AS no_generation
             FROM raw_gsp WINDOW w AS (PARTITION BY gsp_id))
       WHERE no_capacity OR no_generation OR generation_mw IS NOT NULL""",
    OBS,
    LOC,
    RAW_GSP,
)
def settle_areas(spark, sf_dir):
    """Zero rule and missing-value rule from one aggregate."""
    rows = raw_gsp(spark, sf_dir).select("event_id", "gsp_id", "generation_mw", "capacity_mwp")
    return op.settle_areas(rows, "gsp_id").drop("capacity_mwp")
