"""Sources and scans."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from powerflow import sources
from powerflow.catalogue.inputs import OBS, iso_text, observations, table
from powerflow.catalogue.registry import query
from powerflow.functions import epoch_to_utc
from powerflow.operators import assert_contract
from powerflow.schemas import BE_RECORD
from powerflow.session import shared_folder

DAY = timedelta(days=1)

# Belgian responses: one document per reading. "signup" responses have no records; other responses
# hold the reading and a national record, whose time is not readable for "click".
BE_ROWS = """be_rows AS (
    SELECT event_id, 0 AS pos, ts, event_type AS region, power_mw AS realtime,
           power_mw + pct AS mostrecentforecast, CAST(NULLIF(pct, 0) AS DOUBLE) AS monitoredcapacity
    FROM obs WHERE event_type <> 'signup'
    UNION ALL
    SELECT event_id, 1, CASE WHEN event_type <> 'click' THEN ts END, 'belgium', power_mw * 2,
           power_mw, 100.0::DOUBLE
    FROM obs WHERE event_type <> 'signup')"""


def be_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir)
    when = iso_text(F.col("ts"))

    def record(time: Column, region: Column, realtime, forecast, capacity) -> Column:
        return F.struct(
            time.alias("datetime"),
            region.alias("region"),
            realtime.alias("realtime"),
            forecast.alias("mostrecentforecast"),
            capacity.cast("double").alias("monitoredcapacity"),
        )

    power = F.col("power_mw")
    reading = record(
        when,
        F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")),
        power,
        power + F.col("pct"),
        F.nullif(F.col("pct"), F.lit(0)),
    )
    national = record(
        F.when(F.col("event_type") == "click", "no time").otherwise(when),
        F.lit("Belgium"),
        power * 2,
        power,
        F.lit(100.0),
    )
    document = F.to_json(F.struct(F.array(reading, national).alias("results")))
    return obs.select(
        "event_id",
        F.when(F.col("event_type") == "signup", '{"unexpected": []}')
        .otherwise(document)
        .alias("document"),
    )


@query(
    "flatten_records",
    """SELECT event_id, CAST(pos AS INT) AS pos, region, realtime, monitoredcapacity
       FROM be_rows""",
    OBS,
    BE_ROWS,
)
def flatten_records(spark, sf_dir):
    """Records of JSON documents; documents without the array have none."""
    flat = sources.flatten_records(
        be_documents(spark, sf_dir), "results[]", BE_RECORD, keep=["event_id"]
    )
    return flat.select(
        "event_id",
        "pos",
        F.lower(F.trim("region")).alias("region"),
        "realtime",
        "monitoredcapacity",
    )


# Forecast lines: hour 24 and 25 are not readable.
FORECAST_LINES = """lines AS (
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT00:00:00') AS DATE_GMT,
           (o_orderkey % 26) || CASE WHEN o_orderkey % 2 = 0 THEN ':00' ELSE ':30' END AS TIME_GMT,
           o_totalprice AS EMBEDDED_SOLAR_FORECAST
    FROM orders)"""


def forecast_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("DATE_GMT"),
        F.concat(
            (key % 26).cast("string"), F.when(key % 2 == 0, ":00").otherwise(":30")
        ).alias("TIME_GMT"),
        F.col("o_totalprice").alias("EMBEDDED_SOLAR_FORECAST"),
    )


def landed_csv(spark: SparkSession, rows: DataFrame, purpose: str) -> str:
    path = shared_folder(spark, purpose)
    rows.write.option("header", True).csv(path)
    return path


def landed_differently(spark: SparkSession, rows: DataFrame, purpose: str) -> str:
    """Two landed files at least, with the columns in another order and one more in the second half."""
    path = shared_folder(spark, purpose)
    turned = [F.col(name) for name in reversed(rows.columns)]
    rows.filter("o_orderkey % 2 = 0").write.option("header", True).csv(path)
    other = rows.filter("o_orderkey % 2 = 1").select(F.lit("a, b").alias("note"), *turned)
    other.write.mode("append").option("header", True).csv(path)
    return path


@query(
    "read_feed_csv",
    "SELECT DATE_GMT, TIME_GMT, EMBEDDED_SOLAR_FORECAST FROM lines",
    FORECAST_LINES,
)
def read_feed_csv(spark, sf_dir):
    """Landed CSV forecasts with different headers, columns matched by name."""
    return sources.read_feed_csv(
        spark, landed_differently(spark, forecast_lines(spark, sf_dir), "feed-csv")
    )


@query(
    "latest_resource",
    """SELECT event_type, path FROM (
           SELECT event_type, 'feed-' || event_id || '.csv' AS path,
                  row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn
           FROM events) WHERE rn = 1""",
)
def latest_resource(spark, sf_dir):
    """First resource of each package description, then the newest one per feed."""
    paths = F.array(
        F.struct(F.concat(F.lit("feed-"), "event_id", F.lit(".csv")).alias("path")),
        F.struct(F.concat(F.lit("older-"), "event_id", F.lit(".csv")).alias("path")),
    )
    package = F.struct(F.struct(paths.alias("resources")).alias("result"))
    packages = table(spark, sf_dir, "events").select(
        "event_type", "ts", "event_id", F.to_json(package).alias("document")
    )
    named = sources.latest_resource(packages)
    return sources.newest_path(named, ["event_type"], "path", ["ts", "event_id"])


@query(
    "read_locations",
    """SELECT c_name AS name, c_acctbal / 100 AS latitude, c_acctbal / 50 AS longitude,
              CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_custkey AS INT) END AS region_id,
              c_mktsegment AS region, r_name AS country_code, 'STATE' AS location_type,
              'solar' AS energy_source
       FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'""",
)
def read_locations(spark, sf_dir):
    """Location dimension of one country from a CSV of all of them."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    rows = (
        table(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_name").alias("name"),
            (F.col("c_acctbal") / 100).alias("latitude"),
            (F.col("c_acctbal") / 50).alias("longitude"),
            F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")).alias("region_id"),
            F.col("c_mktsegment").alias("region"),
            F.col("r_name").alias("country_code"),
            F.lit("STATE").alias("location_type"),
            F.lit("solar").alias("energy_source"),
        )
    )
    return sources.read_locations(spark, landed_csv(spark, rows, "locations"), "EUROPE")


@query(
    "load_weights",
    """SELECT CAST(c_nationkey AS BIGINT) AS target, c_custkey AS source, c_custkey AS pos,
              CASE WHEN c_acctbal < 5000 THEN CAST(0.27 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS weight
       FROM customer WHERE c_mktsegment = 'BUILDING'""",
)
def load_weights(spark, sf_dir):
    """Weights as rows, the missing ones set to 1, negative ones refused."""
    from powerflow.catalogue.inputs import weights

    return sources.load_weights(spark, weights(spark, sf_dir))


@query(
    "time_chunks",
    """SELECT CAST(i AS INT) AS chunk_no, s + to_days(CAST(i * 5 AS INT)) AS chunk_start,
              least(s + to_days(CAST(i * 5 + 5 AS INT)), e) AS chunk_end,
              (SELECT count(*) FROM events WHERE ts >= s + to_days(CAST(i * 5 AS INT))
                  AND ts < s + to_days(CAST(i * 5 + 5 AS INT)) AND ts < e) AS n_rows
       FROM (SELECT min(ts) AS s, max(ts) AS e FROM events), range(0, 100) t(i)
       WHERE s + to_days(CAST(i * 5 AS INT)) < e""",
)
def time_chunks(spark, sf_dir):
    """Five-day chunks over the extent of the readings, with the readings of each."""
    events = table(spark, sf_dir, "events")
    start, end = events.agg(F.min("ts"), F.max("ts")).first()
    chunks = sources.time_chunks(spark, start, end, step=5 * DAY)
    first = F.lit(str(start)).cast("timestamp_ntz")
    number = F.floor(F.timestamp_diff("MICROSECOND", first, "ts") / (5 * 86_400_000_000))
    inside = sources.time_window(events, "ts", start, end, closed="left")
    counts = inside.groupBy(number.cast("int").alias("chunk_no")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return chunks.join(counts, "chunk_no", "left").na.fill(0, ["n_rows"])


@query(
    "time_chunks_equal",
    """SELECT part, CAST(row_number() OVER (PARTITION BY part ORDER BY low) - 1 AS INT) AS chunk_no,
              make_timestamp(low) AS chunk_start, make_timestamp(high) AS chunk_end
       FROM (SELECT part, i, (first + (i::HUGEINT * length) // n + 1799999999) // 1800000000 * 1800000000 AS edge,
                    lead(edge) OVER (PARTITION BY part ORDER BY i) AS next_edge,
                    CAST(edge AS BIGINT) AS low, CAST(next_edge AS BIGINT) AS high
             FROM (SELECT epoch_us(min(ts)) AS first, epoch_us(max(ts)) - epoch_us(min(ts)) AS length,
                          count(*) AS n_events FROM events),
                  LATERAL (SELECT 'long' AS part, n_events // 100 AS n UNION ALL SELECT 'short', n_events) parts,
                  LATERAL (SELECT unnest(range(n + 1)) AS i) numbers)
       WHERE low < high""",
)
def time_chunks_equal(spark, sf_dir):
    """The extent of the readings in a hundredth as many chunks as readings, and in as many, most of which are empty."""
    events = table(spark, sf_dir, "events")
    start, end, n = events.agg(F.min("ts"), F.max("ts"), F.count(F.lit(1))).first()
    parts = [sources.time_chunks(spark, start, end, n=m).withColumn("part", F.lit(part)) for part, m in (("long", n // 100), ("short", n))]
    return parts[0].unionByName(parts[1])


@query(
    "read_existing_observations",
    """SELECT event_id, location_id, ts, event_type FROM obs
       WHERE event_type = 'view'
         AND ts >= (SELECT min(ts) FROM obs WHERE event_type = 'error' AND power_mw > 100)
         AND ts <= TIMESTAMP '2024-01-25 12:00:00'
         AND location_id IN (SELECT location_id FROM obs WHERE event_type = 'error' AND power_mw > 100)""",
    OBS,
)
def read_existing_observations(spark, sf_dir):
    """Stored readings of one observer that a batch could collide with."""
    obs = observations(spark, sf_dir)
    batch = obs.filter((F.col("event_type") == "error") & (F.col("power_mw") > 100))
    stored = obs.select("event_id", "location_id", "ts", "event_type")
    return sources.read_existing_observations(
        stored,
        batch,
        "view",
        "2024-01-25 12:00:00",
        location="location_id",
        stored_ts="ts",
        batch_ts="ts",
        observer_col="event_type",
    )


@query(
    "sql_feed",
    """SELECT try_strptime(DATE_GMT[:10] || ' ' || TIME_GMT, '%Y-%m-%d %H:%M') AS target_datetime_utc,
              CASE WHEN o_orderkey % 7 <> 0 THEN EMBEDDED_SOLAR_FORECAST END AS solar_generation_kw
       FROM lines WHERE EMBEDDED_SOLAR_FORECAST > 1000 AND target_datetime_utc IS NOT NULL""",
    FORECAST_LINES,
)
def sql_feed(spark, sf_dir):
    """User SQL over the landed forecast, in which some values are no numbers."""
    return sources.sql_feed(
        spark,
        forecast_lines(spark, sf_dir),
        "SELECT DATE_GMT, TIME_GMT, CASE WHEN o_orderkey % 7 = 0 THEN 'x' "
        "ELSE CAST(EMBEDDED_SOLAR_FORECAST AS STRING) END AS EMBEDDED_SOLAR_FORECAST FROM feed "
        "WHERE EMBEDDED_SOLAR_FORECAST > 1000",
    )


# Below the largest id at every scale
MAX_ID = 40


@query("list_active_ids", f"SELECT DISTINCT user_id FROM events WHERE user_id <= {MAX_ID}")
def list_active_ids(spark, sf_dir):
    """Ids that report, up to the maximum."""
    return sources.list_active_ids(table(spark, sf_dir, "events"), MAX_ID, "user_id")


@query("cap_ids", f"SELECT event_id, user_id FROM events WHERE user_id <= {MAX_ID}")
def cap_ids(spark, sf_dir):
    """Readings of ids up to the maximum."""
    return sources.cap_ids(table(spark, sf_dir, "events"), MAX_ID, "user_id").select(
        "event_id", "user_id"
    )


@query(
    "feed_dispatch",
    """SELECT ts AS target_datetime_utc, realtime * 1000 AS solar_generation_kw, region,
              'generation' AS forecast_type, monitoredcapacity * 1000 AS capacity_kw
       FROM be_rows WHERE ts IS NOT NULL AND monitoredcapacity IS NOT NULL
         AND ts BETWEEN TIMESTAMP '2023-12-31 00:00:00' AND TIMESTAMP '2024-01-31 00:00:00'
       QUALIFY row_number() OVER (PARTITION BY region, ts ORDER BY monitoredcapacity DESC, realtime DESC) = 1""",
    OBS,
    BE_ROWS,
)
def feed_dispatch(spark, sf_dir):
    """A country's feed found by name in a landing folder."""
    from powerflow.plans.dispatch import FeedRun
    from powerflow.plans.dispatch import feed_dispatch as dispatch

    landing = shared_folder(spark, "landing")
    documents = be_documents(spark, sf_dir).select("document")
    documents.write.text(f"{landing}/be/generation")
    run = FeedRun(spark, landing, "2024-01-31 00:00:00", backfill_hours=31 * 24)
    return dispatch("be", "generation", run)


@query(
    "assert_contract",
    "SELECT event_id, ts AS target_datetime_utc, value AS solar_generation_kw FROM events",
)
def contract(spark, sf_dir):
    """The frame itself once its required columns are there."""
    return assert_contract(
        table(spark, sf_dir, "events").select(
            "event_id",
            F.col("ts").alias("target_datetime_utc"),
            F.col("value").alias("solar_generation_kw"),
        )
    )


@query(
    "epoch_to_utc",
    "SELECT event_id, date_trunc('second', ts) AS target_datetime_utc FROM events",
)
def epoch(spark, sf_dir):
    """Epoch seconds as text back to a timestamp."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id", epoch_to_utc(seconds).alias("target_datetime_utc")
    )
