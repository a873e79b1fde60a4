"""Joins, set operations and order."""

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
    WEIGHTS,
    facts,
    observations,
    prices,
    raw_gsp,
    registry,
    table,
    weights,
)
from powerflow.catalogue.registry import query
from powerflow.sources import load_weights


def _rebuilding(spark, sf_dir):
    return load_weights(spark, weights(spark, sf_dir))


@query(
    "join_weights",
    """SELECT event_id, source AS gsp_id, target, generation_mw * weight AS generation_mw,
              capacity_mwp * weight AS capacity_mwp
       FROM raw_gsp JOIN w ON gsp_id = source""",
    OBS,
    LOC,
    RAW_GSP,
    WEIGHTS,
)
def join_weights(spark, sf_dir):
    joined = op.join_weights(raw_gsp(spark, sf_dir), _rebuilding(spark, sf_dir))
    return joined.select("event_id", "gsp_id", "target", "generation_mw", "capacity_mwp")


@query(
    "reconstruct_weighted",
    """SELECT target AS gsp_id, datetime_gmt,
              round(coalesce(sum(generation_mw * weight), 0), 6) AS generation_mw,
              round(coalesce(sum(installedcapacity_mwp * weight), 0), 6) AS installedcapacity_mwp,
              round(coalesce(sum(capacity_mwp * weight), 0), 6) AS capacity_mwp,
              max(CASE WHEN pos = first_pos THEN updated_gmt END) AS updated_gmt
       FROM raw_gsp JOIN w ON gsp_id = source
       JOIN (SELECT target, min(pos) AS first_pos FROM w GROUP BY target) USING (target)
       GROUP BY ALL""",
    OBS,
    LOC,
    RAW_GSP,
    WEIGHTS,
)
def reconstruct_weighted(spark, sf_dir):
    rebuilt = op.reconstruct_weighted(raw_gsp(spark, sf_dir), _rebuilding(spark, sf_dir))
    measures = ("generation_mw", "installedcapacity_mwp", "capacity_mwp")
    return rebuilt.withColumns({name: F.round(name, 6) for name in measures})


def hourly(spark, sf_dir):
    return observations(spark, sf_dir).select(
        "event_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts_hour"), "power_mw"
    )


@query(
    "join_prices",
    """SELECT event_id, date_trunc('hour', ts) AS ts_hour, power_mw, eur
       FROM obs LEFT JOIN prices ON date_trunc('hour', ts) = ts_hour""",
    OBS,
    PRICES,
)
def join_prices(spark, sf_dir):
    return op.join_prices(hourly(spark, sf_dir), prices(spark, sf_dir), "ts_hour")


@query(
    "potential_generation",
    """SELECT event_id, power_mw, CASE WHEN eur <= 0 THEN power_mw * 1.11::DOUBLE ELSE power_mw END
              AS solar_generation_no_curtailment_kw
       FROM obs LEFT JOIN prices ON date_trunc('hour', ts) = ts_hour""",
    OBS,
    PRICES,
)
def potential_generation(spark, sf_dir):
    potential = op.potential_generation(
        hourly(spark, sf_dir),
        prices(spark, sf_dir),
        ts="ts_hour",
        price="eur",
        generation="power_mw",
    )
    return potential.drop("eur", "ts_hour")


@query(
    "drop_existing",
    """SELECT event_id, location_id, ts, event_type FROM obs o WHERE NOT EXISTS (
           SELECT 1 FROM obs s WHERE s.power_mw > 5 AND s.location_id = o.location_id
              AND s.ts = o.ts AND s.event_type = o.event_type)""",
    OBS,
)
def drop_existing(spark, sf_dir):
    """Readings not stored yet for the same location, time and observer."""
    obs = observations(spark, sf_dir)
    batch = obs.select("event_id", "location_id", "ts", "event_type")
    return op.drop_existing(
        batch, obs.filter("power_mw > 5"), ["location_id", "ts", "event_type"]
    )


@query(
    "exclude_merge_targets",
    """SELECT DISTINCT user_id AS gsp_id FROM events
       WHERE user_id NOT IN (SELECT target FROM w)""",
    WEIGHTS,
)
def exclude_merge_targets(spark, sf_dir):
    ids = table(spark, sf_dir, "events").select(F.col("user_id").alias("gsp_id")).distinct()
    return op.exclude_merge_targets(ids, _rebuilding(spark, sf_dir))


@query(
    "unmatched_keys",
    """SELECT DISTINCT gsp_id FROM facts JOIN customer ON gsp_id = c_custkey
       WHERE customer.c_mktsegment = 'FURNITURE'""",
    OBS,
    LOC,
    FACTS,
)
def unmatched_keys(spark, sf_dir):
    return op.unmatched_keys(facts(spark, sf_dir), registry(spark, sf_dir), HOME)


@query(
    "missing_members",
    """SELECT c_custkey AS user_id, c_name FROM customer
       WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)""",
)
def missing_members(spark, sf_dir):
    """Customers that never report."""
    required = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_name"
    )
    return op.missing_members(required, table(spark, sf_dir, "events"), "user_id")


@query(
    "set_difference",
    "SELECT o_custkey AS user_id FROM orders EXCEPT SELECT user_id FROM events",
)
def set_difference(spark, sf_dir):
    """Customers that order but never report."""
    ordering = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"))
    return op.set_difference(ordering, table(spark, sf_dir, "events"), "user_id")


@query(
    "registry_equality",
    """SELECT key, CAST(sum(n) AS BIGINT) AS surplus FROM (
           SELECT o_custkey AS key, 1 AS n FROM orders
           UNION ALL SELECT user_id, -1 FROM events)
       GROUP BY key HAVING sum(n) <> 0""",
)
def registry_equality(spark, sf_dir):
    """Where two lists with repetitions differ, and by how much."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"))
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"))
    return op.registry_equality(orders, events)


@query(
    "join_name_map",
    """SELECT c_custkey, n_nationkey, n_name FROM customer JOIN nation
       ON 'NATION_' || c_nationkey = n_name""",
)
def join_name_map(spark, sf_dir):
    """Names of a boundary list to the ids of the registry."""
    named = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("NATION_"), "c_nationkey").alias("area_name")
    )
    names = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return op.join_name_map(named, names, "area_name", "n_name")


@query(
    "union_feeds",
    """SELECT event_id AS id, ts, value AS power, event_type AS region FROM events
       UNION ALL SELECT o_orderkey, o_orderdate, o_totalprice, NULL FROM orders""",
)
def union_feeds(spark, sf_dir):
    """Feeds with different columns, the missing one NULL."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), "ts", F.col("value").alias("power"),
        F.col("event_type").alias("region"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_totalprice").alias("power"), F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("ts"),
    )
    return op.union_feeds(events, orders)


@query("order_output", "SELECT ts, event_type, value FROM events ORDER BY ts, event_type")
def order_output(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("ts", "event_type", "value")
    return op.order_output(rows, ["ts", "event_type"])
