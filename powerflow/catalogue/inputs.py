"""The driver tables read as the domain's inputs, in Spark and in SQL.

Events stand for power readings of a location at a time, customers for locations with a capacity,
orders for daily totals per region.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from powerflow.functions.times import floor_time
from powerflow.functions.metadata import number_tag, string_tag, tagged_map
from powerflow.settings import CountryProfile


TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; with its schema given, no file has to be opened to plan a query."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


# Readings: one row per event. ``pct`` is the number inside the JSON properties.
OBS = """obs AS (
    SELECT event_id, user_id AS location_id, ts, value AS power_mw, event_type,
           CAST(json_extract(props, '$.k') AS INT) AS pct
    FROM events)"""


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("location_id"),
        "ts",
        F.col("value").alias("power_mw"),
        "event_type",
        F.from_json("props", "k INT").getField("k").alias("pct"),
    )


# Locations: a customer's balance, when positive, is its capacity in MW.
LOC = """loc AS (
    SELECT c_custkey AS location_id, c_name, c_nationkey, c_mktsegment,
           CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0 END AS capacity_mw
    FROM customer)"""


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("location_id"),
        "c_name",
        "c_nationkey",
        "c_mktsegment",
        F.when(balance > 0, balance).otherwise(F.lit(0.0)).alias("capacity_mw"),
    )


# Facts of a generation feed. BUILDING customers have no published capacity.
FACTS = """facts AS (
    SELECT event_id, event_type, ts AS target_datetime_utc, location_id AS gsp_id,
           power_mw * 1000 AS solar_generation_kw,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN capacity_mw * 1000 END AS capacity_kw,
           CASE WHEN event_type IN ('view', 'click') THEN 'in-day' ELSE 'day-after' END AS regime
    FROM obs JOIN loc USING (location_id))"""


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = observations(spark, sf_dir).join(locations(spark, sf_dir), "location_id")
    published = F.col("c_mktsegment") != "BUILDING"
    return joined.select(
        "event_id",
        "event_type",
        F.col("ts").alias("target_datetime_utc"),
        F.col("location_id").alias("gsp_id"),
        (F.col("power_mw") * 1000).alias("solar_generation_kw"),
        F.when(published, F.col("capacity_mw") * 1000).alias("capacity_kw"),
        F.when(F.col("event_type").isin("view", "click"), "in-day")
        .otherwise("day-after")
        .alias("regime"),
    )


# Registry: every customer is a location with its id in the metadata; FURNITURE customers carry
# none and cannot be joined.
REG = """reg AS (
    SELECT 'loc-' || c_custkey AS location_uuid, c_name AS location_name, c_custkey AS gsp_id,
           c_nationkey, c_mktsegment,
           CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0 END * 1000000 AS effective_capacity_watts
    FROM customer)"""

HOME = CountryProfile("gb", "gsp_id", "number", None, ("STATE",), seeded=False)


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    identified = tagged_map(gsp_id=number_tag(F.col("location_id")))
    nameless = tagged_map(segment=string_tag(F.col("c_mktsegment")))
    return locations(spark, sf_dir).select(
        F.concat(F.lit("loc-"), F.col("location_id")).alias("location_uuid"),
        F.col("c_name").alias("location_name"),
        F.lit("SOLAR").alias("energy_source"),
        F.lit("STATE").alias("location_type"),
        (F.col("capacity_mw") * 1_000_000).alias("effective_capacity_watts"),
        F.when(F.col("c_mktsegment") == "FURNITURE", nameless).otherwise(identified).alias(
            "metadata"
        ),
    )


# Stored observations: readings above 5 MW have been saved before.
def stored_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        facts(spark, sf_dir)
        .filter(F.col("solar_generation_kw") > 5000)
        .select(
            F.concat(F.lit("loc-"), F.col("gsp_id")).alias("location_uuid"),
            F.lit("SOLAR").alias("energy_source"),
            F.concat(F.lit("pvlive_"), F.replace("regime", F.lit("-"), F.lit("_"))).alias(
                "observer_name"
            ),
            F.col("target_datetime_utc").alias("timestamp_utc"),
        )
    )


# Weights: BUILDING customers are the sources that rebuild the area of their nation.
WEIGHTS = """w AS (
    SELECT CAST(c_nationkey AS BIGINT) AS target, c_custkey AS source, c_custkey AS pos,
           CASE WHEN c_acctbal < 5000 THEN CAST(0.27 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS weight
    FROM customer WHERE c_mktsegment = 'BUILDING')"""


def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") == "BUILDING")
        .select(
            F.col("c_nationkey").cast("bigint").alias("target"),
            F.col("c_custkey").alias("source"),
            F.when(F.col("c_acctbal") < 5000, F.lit(0.27)).alias("weight"),
            F.col("c_custkey").alias("pos"),
        )
    )


# Raw area rows: half-hourly readings; "error" readings are missing and so is everything of the
# locations in nation 3.
RAW_GSP = """raw_gsp AS (
    SELECT event_id, location_id AS gsp_id, time_bucket(INTERVAL 30 MINUTE, ts) AS datetime_gmt,
           CASE WHEN event_type <> 'error' AND c_nationkey <> 3 THEN power_mw END AS generation_mw,
           capacity_mw * 1.5 AS installedcapacity_mwp, capacity_mw AS capacity_mwp,
           ts AS updated_gmt
    FROM obs JOIN loc USING (location_id))"""


def half_hour(ts: Column) -> Column:
    return floor_time(ts, 30)


def raw_gsp(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = observations(spark, sf_dir).join(locations(spark, sf_dir), "location_id")
    known = (F.col("event_type") != "error") & (F.col("c_nationkey") != 3)
    return joined.select(
        "event_id",
        F.col("location_id").alias("gsp_id"),
        half_hour(F.col("ts")).alias("datetime_gmt"),
        F.when(known, F.col("power_mw")).alias("generation_mw"),
        (F.col("capacity_mw") * 1.5).alias("installedcapacity_mwp"),
        F.col("capacity_mw").alias("capacity_mwp"),
        F.col("ts").alias("updated_gmt"),
    )


# Hourly prices: a balance at or below zero is a price at or below zero.
PRICES = """prices AS (
    SELECT TIMESTAMP '2024-01-01 00:00:00' + to_hours(c_custkey) AS ts_hour, c_acctbal AS eur
    FROM customer)"""


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    hours = F.make_dt_interval(hours=F.col("c_custkey").cast("int"))
    return table(spark, sf_dir, "customer").select(
        (start + hours).alias("ts_hour"), F.col("c_acctbal").alias("eur")
    )


# Daily totals: regions 1..5 without pending orders and 0, the national total of all orders.
DAILY = """daily AS (
    SELECT o_orderdate AS day, n_regionkey + 1 AS region_id,
           round(sum(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END), 2) AS capacity,
           count(*) AS n_orders
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY ALL
    UNION ALL
    SELECT o_orderdate, 0, round(sum(o_totalprice), 2), count(*) FROM orders GROUP BY ALL)"""

REGION_IDS = [0, 1, 2, 3, 4, 5]


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("day"), "o_custkey", "o_orderstatus", "o_totalprice"
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    settled = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    regional = placed.groupBy("day", (F.col("n_regionkey") + 1).alias("region_id")).agg(
        F.round(F.sum(settled), 2).alias("capacity"), F.count(F.lit(1)).alias("n_orders")
    )
    national = orders.groupBy("day", F.lit(0).alias("region_id")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("capacity"), F.count(F.lit(1)).alias("n_orders")
    )
    return regional.unionByName(national)


def iso_text(ts: Column) -> Column:
    """ISO-8601 text with a UTC offset."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
