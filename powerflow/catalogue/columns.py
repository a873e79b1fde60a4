"""Projections and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from powerflow import functions as pf
from powerflow.catalogue.inputs import FACTS, LOC, OBS, facts, locations, observations, table
from powerflow.catalogue.registry import query
from powerflow.catalogue.scans import FORECAST_LINES, forecast_lines
from powerflow.operators import pick_series
from powerflow.settings import DE_TSO_NAMES


@query("mw_to_kw", "SELECT event_id, value * 1000 AS power_kw FROM events")
def mw_to_kw(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", pf.mw_to_kw(F.col("value")).alias("power_kw")
    )


@query(
    "kw_to_watts",
    """SELECT event_id, CAST(trunc(value / 7 * 1000) AS BIGINT) AS watts,
              CAST(trunc(-value / 7 * 1000) AS BIGINT) AS negative_watts FROM events""",
)
def kw_to_watts(spark, sf_dir):
    """Truncated toward zero on both sides of it."""
    kw = F.col("value") / 7
    return table(spark, sf_dir, "events").select(
        "event_id",
        pf.kw_to_watts(kw).alias("watts"),
        pf.kw_to_watts(-F.col("value") / 7).alias("negative_watts"),
    )


@query(
    "parse_date_time",
    """SELECT o_orderkey,
              try_strptime(DATE_GMT[:10] || ' ' || TIME_GMT, '%Y-%m-%d %H:%M') AS target_datetime_utc
       FROM lines""",
    FORECAST_LINES,
)
def parse_date_time(spark, sf_dir):
    """Hours 24 and 25 give NULL."""
    padded = F.concat(F.lit("  "), F.col("TIME_GMT"), F.lit(" "))
    return forecast_lines(spark, sf_dir).select(
        "o_orderkey", pf.parse_date_time(F.col("DATE_GMT"), padded).alias("target_datetime_utc")
    )


@query(
    "local_to_utc",
    """SELECT event_id, (ts AT TIME ZONE 'Europe/Berlin') AT TIME ZONE 'UTC' AS ts_utc
       FROM events""",
)
def local_to_utc(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", pf.local_to_utc(F.col("ts"), "Europe/Berlin").alias("ts_utc")
    )


@query(
    "parse_iso_utc",
    """SELECT event_id,
              CASE WHEN event_type = 'error' THEN NULL
                   WHEN event_type = 'view' THEN date_trunc('second', ts) - INTERVAL 2 HOUR
                   ELSE date_trunc('second', ts) END AS ts_utc
       FROM events""",
)
def parse_iso_utc(spark, sf_dir):
    """Offsets are applied; text that is not a time gives NULL."""
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.col("event_type")
    written = (
        F.when(kind == "error", "not a time")
        .when(kind == "view", F.concat(text, F.lit("+02:00")))
        .otherwise(F.concat(text, F.lit("Z")))
    )
    return table(spark, sf_dir, "events").select("event_id", pf.parse_iso_utc(written).alias("ts_utc"))


@query(
    "floor_time",
    """SELECT event_id, time_bucket(INTERVAL 30 MINUTE, ts) AS half_hour,
              time_bucket(INTERVAL 15 MINUTE, ts) AS quarter,
              date_trunc('hour', ts) AS hour, date_trunc('day', ts)::TIMESTAMP AS day
       FROM events""",
)
def floor_time(spark, sf_dir):
    steps = {"half_hour": 30, "quarter": 15, "hour": 60, "day": 1440}
    return table(spark, sf_dir, "events").select(
        "event_id", *[pf.floor_time(F.col("ts"), n).alias(name) for name, n in steps.items()]
    )


@query("normalise_key", "SELECT event_id, lower(trim('  ' || upper(event_type) || ' ')) AS key FROM events")
def normalise_key(spark, sf_dir):
    padded = F.concat(F.lit("  "), F.upper("event_type"), F.lit(" "))
    return table(spark, sf_dir, "events").select("event_id", pf.normalise_key(padded).alias("key"))


@query(
    "tag_constants",
    "SELECT event_id, value, 'in-day' AS regime, CAST(0 AS INT) AS gsp_id FROM events",
)
def tag_constants(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "value")
    return pf.tag_constants(rows, regime="in-day", gsp_id=0)


# Readings per German control area; "signup" is the national total and has no operator.
DE_REGION = """CASE event_type WHEN 'click' THEN '50hertz' WHEN 'view' THEN 'amprion'
    WHEN 'purchase' THEN 'tennet' WHEN 'error' THEN 'transnetbw' ELSE 'de' END"""
DE_REGIONS = {
    "click": "50hertz",
    "view": "amprion",
    "purchase": "tennet",
    "error": "transnetbw",
    "signup": "de",
}


@query(
    "lookup_map",
    f"""SELECT event_id, region, CASE region WHEN '50hertz' THEN '50Hertz' WHEN 'amprion' THEN 'Amprion'
              WHEN 'tennet' THEN 'TenneT' WHEN 'transnetbw' THEN 'TransnetBW' END AS tso_zone
        FROM (SELECT event_id, {DE_REGION} AS region FROM events)""",
)
def lookup_map(spark, sf_dir):
    """A key outside the map gives NULL."""
    region = pf.lookup_map(F.col("event_type"), DE_REGIONS)
    return table(spark, sf_dir, "events").select(
        "event_id", region.alias("region"), pf.lookup_map(region, DE_TSO_NAMES).alias("tso_zone")
    )


@query(
    "canonical_schema",
    "SELECT ts AS target_datetime_utc, value AS solar_generation_kw FROM events",
)
def canonical_schema(spark, sf_dir):
    columns = [("ts", "target_datetime_utc"), ("value", "solar_generation_kw")]
    return pf.canonical_schema(table(spark, sf_dir, "events"), columns)


WIDE = """wide AS (
    SELECT event_id, ts, CASE WHEN event_type = 'view' THEN power_mw END AS solar,
           CASE WHEN event_type = 'click' THEN power_mw END AS wind
    FROM obs)"""


@query(
    "pick_series",
    "SELECT event_id, ts, solar AS value FROM wide WHERE solar IS NOT NULL",
    OBS,
    WIDE,
)
def series(spark, sf_dir):
    """The aggregated Solar column out of a wide table with two-part names."""
    obs = observations(spark, sf_dir)
    wide = obs.select(
        "event_id",
        "ts",
        F.col("pct").cast("double").alias("Solar|Actual Consumption"),
        F.when(F.col("event_type") == "click", F.col("power_mw")).alias(
            "Wind Onshore|Actual Aggregated"
        ),
        F.when(F.col("event_type") == "view", F.col("power_mw")).alias("Solar|Actual Aggregated"),
        (F.col("power_mw") * 2).alias("Solar|Actual Aggregated.1"),
    )
    return pick_series(wide, ["event_id", "ts"])


@query(
    "point_wkt",
    """SELECT s_suppkey, 'POINT(' || CAST(s_acctbal AS VARCHAR) || ' ' || CAST(s_nationkey AS VARCHAR)
              || ')' AS geometry_wkt FROM supplier""",
)
def point_wkt(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", pf.point_wkt(F.col("s_acctbal"), F.col("s_nationkey")).alias("geometry_wkt")
    )


@query(
    "derive_names",
    """SELECT event_id, 'ruvnl_' || event_type AS asset,
              'pvlive_' || replace(regime, '-', '_') AS observer,
              replace('neso-' || regime, '-', '_') AS forecaster,
              'entsoe-de-' || replace(event_type || '_ahead', '_', '-') AS de_forecaster
       FROM facts""",
    OBS,
    LOC,
    FACTS,
)
def derive_names(spark, sf_dir):
    regime, kind = F.col("regime"), F.col("event_type")
    return facts(spark, sf_dir).select(
        "event_id",
        pf.derive_names("asset", kind).alias("asset"),
        pf.derive_names("observer", regime).alias("observer"),
        pf.derive_names("forecaster", F.concat(F.lit("neso-"), regime)).alias("forecaster"),
        pf.derive_names("de_forecaster", F.concat(kind, F.lit("_ahead"))).alias("de_forecaster"),
    )


def _metadata():
    return pf.tagged_map(
        gsp_id=pf.number_tag(F.col("c_nationkey")), segment=pf.string_tag(F.col("c_mktsegment"))
    )


@query(
    "metadata_value",
    """SELECT location_id, CAST(c_nationkey AS DOUBLE) AS gsp_id, c_mktsegment AS segment,
              CAST(NULL AS VARCHAR) AS missing FROM loc""",
    LOC,
)
def metadata_value(spark, sf_dir):
    tags = _metadata()
    return locations(spark, sf_dir).select(
        "location_id",
        pf.metadata_value(tags, "gsp_id", "number").alias("gsp_id"),
        pf.metadata_value(tags, "segment", "string").alias("segment"),
        pf.metadata_value(tags, "country", "string").alias("missing"),
    )


@query(
    "merge_metadata",
    """SELECT location_id, CAST(c_nationkey AS DOUBLE) AS gsp_id, c_mktsegment AS segment,
              trunc(capacity_mw * 1.5) AS undegraded, CAST(3 AS INT) AS n_entries FROM loc""",
    LOC,
)
def merge_metadata(spark, sf_dir):
    """Existing entries stay, one is set, a second merge overwrites it."""
    key = "capacity_no_degradation_kw"
    once = pf.merge_metadata(_metadata(), key, F.lit(1.0))
    return (
        locations(spark, sf_dir)
        .withColumn("tags", pf.merge_metadata(once, key, F.col("capacity_mw") * 1.5))
        .select(
            "location_id",
            pf.metadata_value(F.col("tags"), "gsp_id", "number").alias("gsp_id"),
            pf.metadata_value(F.col("tags"), "segment", "string").alias("segment"),
            pf.metadata_value(F.col("tags"), key, "number").alias("undegraded"),
            F.size("tags").alias("n_entries"),
        )
    )


@query(
    "capacity_from_percentage",
    """SELECT event_id, CASE WHEN pct <> 0 THEN power_mw / (CAST(pct AS DOUBLE) / 100) END AS capacity
       FROM obs""",
    OBS,
)
def capacity_from_percentage(spark, sf_dir):
    """No capacity where the fraction is zero."""
    fraction = F.col("pct").cast("double") / 100
    return observations(spark, sf_dir).select(
        "event_id", pf.capacity_from_percentage(F.col("power_mw"), fraction).alias("capacity")
    )


HORIZON = "(epoch_us(target_datetime_utc) - epoch_us(TIMESTAMP '2024-01-15 00:00:00')) / 60000000.0::DOUBLE"


@query(
    "forecast_horizon",
    f"""SELECT event_id, target_datetime_utc + INTERVAL 15 MINUTE AS end_utc,
              {HORIZON} AS horizon_minutes, CAST(trunc({HORIZON}) AS INT) AS horizon_mins
        FROM facts""",
    OBS,
    LOC,
    FACTS,
)
def forecast_horizon(spark, sf_dir):
    steps = facts(spark, sf_dir).select("event_id", "target_datetime_utc")
    dated = pf.forecast_horizon(steps, pf.utc_literal("2024-01-15 00:00:00"))
    return dated.drop("target_datetime_utc")


@query(
    "drop_past_horizon",
    f"""SELECT event_id, CAST(trunc({HORIZON}) AS INT) AS horizon_mins FROM facts
        WHERE trunc({HORIZON}) >= 0""",
    OBS,
    LOC,
    FACTS,
)
def drop_past_horizon(spark, sf_dir):
    steps = facts(spark, sf_dir).select("event_id", "target_datetime_utc")
    dated = pf.forecast_horizon(steps, pf.utc_literal("2024-01-15 00:00:00"))
    return pf.drop_past_horizon(dated).select("event_id", "horizon_mins")


@query(
    "p50_fraction",
    """SELECT event_id, power_mw * 1000 * 1000 / (capacity_mw * 1000000) AS p50
       FROM obs JOIN loc USING (location_id) WHERE capacity_mw > 0""",
    OBS,
    LOC,
)
def p50_fraction(spark, sf_dir):
    joined = observations(spark, sf_dir).join(
        locations(spark, sf_dir).filter("capacity_mw > 0"), "location_id"
    )
    fraction = pf.p50_fraction(F.col("power_mw") * 1000, F.col("capacity_mw") * 1_000_000)
    return joined.select("event_id", fraction.alias("p50"))


@query(
    "cast_float32",
    """SELECT event_id, CAST(CAST(value / 3 AS FLOAT) AS DOUBLE) AS value32 FROM events""",
)
def cast_float32(spark, sf_dir):
    """32-bit values, widened again for the comparison."""
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("value") / 3).alias("value32"))
    return pf.cast_float32(rows, ["value32"]).withColumn("value32", F.col("value32").cast("double"))
