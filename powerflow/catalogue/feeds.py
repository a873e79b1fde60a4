"""Whole feeds, from landed rows or documents to the delivered columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from powerflow import plans
from powerflow.catalogue.columns import DE_REGION, DE_REGIONS
from powerflow.catalogue.inputs import (
    DAILY,
    LOC,
    OBS,
    RAW_GSP,
    REGION_IDS,
    WEIGHTS,
    daily,
    iso_text,
    observations,
    raw_gsp,
    table,
    weights,
)
from powerflow.catalogue.registry import ORACLES, query
from powerflow.catalogue.scans import BE_ROWS, FORECAST_LINES, be_documents, forecast_lines
from powerflow.catalogue.totals import CAPACITIES, capacities
from powerflow.operators.curtailment import POTENTIAL, PRICE
from powerflow.plans.dispatch import FeedRun
from powerflow.session import shared_folder
from powerflow.sources import load_weights

KW = ("solar_generation_kw", "capacity_kw", "capacity_no_degradation_kw")

SETTLED = """settled AS (
    SELECT gsp_id, datetime_gmt, installedcapacity_mwp, capacity_mwp, updated_gmt,
           CASE WHEN no_capacity THEN 0 ELSE generation_mw END AS generation_mw
    FROM (SELECT *, coalesce(sum(capacity_mwp) OVER a, 0) = 0 AS no_capacity,
                 count(generation_mw) OVER a = 0 AS no_generation
          FROM {rows} WINDOW a AS (PARTITION BY gsp_id))
    WHERE no_capacity OR no_generation OR generation_mw IS NOT NULL)"""

GB_COLUMNS = """SELECT round(1000 * generation_mw, 3) AS solar_generation_kw,
       datetime_gmt AS target_datetime_utc, round(1000 * capacity_mwp, 3) AS capacity_kw,
       round(1000 * installedcapacity_mwp, 3) AS capacity_no_degradation_kw,
       updated_gmt AS pvlive_updated_utc, 'in-day' AS regime, gsp_id FROM settled"""


def rounded(df, names=KW, digits=3):
    return df.withColumns({name: F.round(name, digits) for name in names})


@query("process_gsp", GB_COLUMNS, OBS, LOC, RAW_GSP, SETTLED.format(rows="raw_gsp"))
def process_gsp(spark, sf_dir):
    """Quality rules and units of all areas at once."""
    return rounded(plans.process_gsp(raw_gsp(spark, sf_dir), "in-day"))


# Of several polls of an area and time the newest counts.
NEWEST_GSP = RAW_GSP.replace("raw_gsp AS", "polled AS", 1) + """,
    raw_gsp AS (SELECT * FROM polled QUALIFY row_number() OVER (
        PARTITION BY gsp_id, datetime_gmt ORDER BY updated_gmt DESC, capacity_mwp DESC,
        generation_mw DESC NULLS LAST) = 1)"""


# A source that is delivered directly, i.e. whose id is not a target, enters the sums after its
# own zero-capacity rule.
GB_ROWS = """ids AS (SELECT c_custkey AS gsp_id FROM customer
        WHERE c_custkey NOT IN (SELECT target FROM w)),
    direct AS (SELECT gsp_id, datetime_gmt, generation_mw, installedcapacity_mwp, capacity_mwp,
                      updated_gmt FROM raw_gsp SEMI JOIN ids USING (gsp_id)),
    sources AS (
        SELECT gsp_id, datetime_gmt, installedcapacity_mwp, capacity_mwp, updated_gmt,
               CASE WHEN gsp_id IN (SELECT gsp_id FROM ids)
                     AND coalesce(sum(capacity_mwp) OVER (PARTITION BY gsp_id), 0) = 0
                    THEN 0 ELSE generation_mw END AS generation_mw
        FROM raw_gsp),
    rebuilt AS (
        SELECT target AS gsp_id, datetime_gmt, coalesce(sum(generation_mw * weight), 0) AS generation_mw,
               coalesce(sum(installedcapacity_mwp * weight), 0) AS installedcapacity_mwp,
               coalesce(sum(capacity_mwp * weight), 0) AS capacity_mwp,
               max(CASE WHEN pos = first_pos THEN updated_gmt END) AS updated_gmt
        FROM sources JOIN w ON gsp_id = source
        JOIN (SELECT target, min(pos) AS first_pos FROM w GROUP BY target) USING (target)
        GROUP BY ALL),
    areas AS (SELECT * FROM direct UNION ALL BY NAME SELECT * FROM rebuilt)"""


@query("gb_generation", GB_COLUMNS, OBS, LOC, NEWEST_GSP, WEIGHTS, GB_ROWS, SETTLED.format(rows="areas"))
def gb_generation(spark, sf_dir):
    """Areas that report plus the areas rebuilt from weighted sources."""
    registry = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("gsp_id"))
    generation = plans.gb_generation(
        raw_gsp(spark, sf_dir).drop("event_id"),
        registry,
        load_weights(spark, weights(spark, sf_dir)),
        "in-day",
        "2024-01-31 00:00:00",
        max_id=None,
        backfill_hours=31 * 24,
    )
    return rounded(generation)


@query(
    "gb_forecast",
    """SELECT try_strptime(DATE_GMT[:10] || ' ' || TIME_GMT, '%Y-%m-%d %H:%M') AS target_datetime_utc,
              EMBEDDED_SOLAR_FORECAST * 1000 AS solar_generation_kw
       FROM lines WHERE target_datetime_utc IS NOT NULL""",
    FORECAST_LINES,
)
def gb_forecast(spark, sf_dir):
    return plans.gb_forecast(forecast_lines(spark, sf_dir))


# Dutch responses: one document per day and region, with an hour of the day as its period. Busy
# cells are updated too soon after it, on the 13th the percentage is small and on the 14th zero.
NL_ROWS = """nl_rows AS (
    SELECT day::DATE AS request_date, CAST(region_id AS INT) AS region_id, capacity,
           capacity / 4 AS volume,
           CASE day(day) WHEN 13 THEN 0.005 WHEN 14 THEN 0 ELSE 0.5 END::DOUBLE AS percentage,
           day + INTERVAL 12 HOUR AS validfrom, day + INTERVAL 13 HOUR AS validto,
           day + INTERVAL 13 HOUR
               + to_minutes(CASE WHEN n_orders > 30 THEN 10 ELSE 30 END) AS lastupdate
    FROM daily WHERE capacity IS NOT NULL)"""


def nl_documents(spark, sf_dir):
    rows = daily(spark, sf_dir).filter(F.col("capacity").isNotNull())
    number = F.dayofmonth("day")
    percentage = F.when(number == 13, 0.005).when(number == 14, 0.0).otherwise(0.5)
    end = F.col("day") + F.make_dt_interval(hours=F.lit(13))
    lag = F.make_dt_interval(mins=F.when(F.col("n_orders") > 30, 10).otherwise(30))
    member = F.struct(
        F.lit(1).alias("id"),
        F.lit("/v1/points/0").alias("point"),
        "capacity",
        (F.col("capacity") / 4).alias("volume"),
        percentage.alias("percentage"),
        iso_text(F.col("day") + F.make_dt_interval(hours=F.lit(12))).alias("validfrom"),
        iso_text(end).alias("validto"),
        iso_text(end + lag).alias("lastupdate"),
    )
    return rows.select(
        F.to_date("day").alias("request_date"),
        "region_id",
        F.to_json(F.struct(F.array(member).alias("hydra:member"))).alias("document"),
    )


NL_PRICES = f"""nl_prices AS (
    SELECT o_orderdate + INTERVAL 12 HOUR AS target_datetime_utc,
           (max(o_totalprice) - 450000) / 1000 AS "{PRICE}"
    FROM orders GROUP BY o_orderdate)"""


def nl_prices(spark, sf_dir):
    noon = F.col("o_orderdate") + F.make_dt_interval(hours=F.lit(12))
    price = (F.max("o_totalprice") - 450000) / 1000
    return table(spark, sf_dir, "orders").groupBy(noon.alias("target_datetime_utc")).agg(
        price.alias(PRICE)
    )


# Delivered rows of a set of records, with the capacity check on them.
NL_DELIVERED = """records AS (SELECT * FROM nl_rows WHERE {rule}),
    totals AS (
        SELECT capacity AS "capacity (kW)", volume AS "volume (kWh)",
               validfrom AS target_datetime_utc, validto AS "validto (UTC)",
               lastupdate AS "lastupdate (UTC)", region_id,
               percentage >= 0.01::DOUBLE AS large,
               CASE WHEN percentage <> 0 THEN capacity / percentage END AS capacity_kw,
               capacity AS solar_generation_kw FROM records),
    checks AS (
        SELECT target_datetime_utc, count(*) = 6 AND count(DISTINCT region_id) = 6
                   AND min(region_id) = 0 AND max(region_id) = 5
                   AND abs(sum(CASE WHEN region_id <> 0 THEN capacity_kw END)
                           - max(CASE WHEN region_id = 0 THEN capacity_kw END))
                       <= 0.001::DOUBLE * abs(max(CASE WHEN region_id = 0 THEN capacity_kw END)) AS good
        FROM totals WHERE capacity_kw IS NOT NULL GROUP BY target_datetime_utc),
    delivered AS (
        SELECT * EXCLUDE (large, good), large AND coalesce(good, false) AS update_capacity
        FROM totals LEFT JOIN checks USING (target_datetime_utc))"""

NL_SETTLED = "validto < lastupdate - INTERVAL 15 MINUTE"


@query(
    "nl_generation",
    f"""SELECT d.*, "{PRICE}", CASE WHEN "{PRICE}" <= 0 THEN solar_generation_kw * 1.11::DOUBLE
               ELSE solar_generation_kw END AS {POTENTIAL}
        FROM delivered d LEFT JOIN nl_prices USING (target_datetime_utc)""",
    DAILY,
    NL_ROWS,
    NL_PRICES,
    NL_DELIVERED.format(rule=NL_SETTLED),
)
def nl_generation(spark, sf_dir):
    """All landed generation with capacity check and potential generation."""
    return plans.nl_generation(
        nl_documents(spark, sf_dir), None, nl_prices(spark, sf_dir), REGION_IDS
    )


@query(
    "nl_forecast",
    "SELECT * FROM delivered",
    DAILY,
    NL_ROWS,
    NL_DELIVERED.format(
        rule="validfrom BETWEEN TIMESTAMP '1996-06-15 10:00:00' AND TIMESTAMP '1996-06-22 12:00:00'"
    ),
)
def nl_forecast(spark, sf_dir):
    """From two hours back to seven days ahead."""
    return plans.nl_forecast(nl_documents(spark, sf_dir), "1996-06-15 12:00:00", REGION_IDS)


@query(
    "no_curtailment_variant",
    f"""SELECT target_datetime_utc, region_id, CASE WHEN "{PRICE}" <= 0
               THEN solar_generation_kw * 1.11::DOUBLE ELSE solar_generation_kw END AS solar_generation_kw
        FROM delivered LEFT JOIN nl_prices USING (target_datetime_utc)""",
    DAILY,
    NL_ROWS,
    NL_PRICES,
    NL_DELIVERED.format(rule=NL_SETTLED),
)
def no_curtailment_variant(spark, sf_dir):
    """The potential generation in the place of the generation."""
    variant = plans.no_curtailment_variant(nl_generation(spark, sf_dir))
    return variant.select("target_datetime_utc", "region_id", "solar_generation_kw")


@query(
    "be_generation",
    """SELECT ts AS target_datetime_utc, realtime * 1000 AS solar_generation_kw, region,
              'generation' AS forecast_type, monitoredcapacity * 1000 AS capacity_kw
       FROM be_rows WHERE ts IS NOT NULL AND monitoredcapacity IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY region, ts ORDER BY monitoredcapacity DESC, realtime DESC) = 1""",
    OBS,
    BE_ROWS,
)
def be_generation(spark, sf_dir):
    """All landed generation; records without a time or capacity are dropped."""
    return plans.be_generation(be_documents(spark, sf_dir))


@query(
    "be_forecast",
    """SELECT ts AS target_datetime_utc, mostrecentforecast * 1000 AS solar_generation_kw, region,
              'most_recent' AS forecast_type, monitoredcapacity * 1000 AS capacity_kw
       FROM be_rows WHERE ts IS NOT NULL AND monitoredcapacity IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY region, ts ORDER BY monitoredcapacity DESC, mostrecentforecast DESC) = 1""",
    OBS,
    BE_ROWS,
)
def be_forecast(spark, sf_dir):
    return plans.be_forecast(be_documents(spark, sf_dir))


# German areas: readings with pct 0 are missing, "tennet" lands no solar column at all.
DE_ROWS = f"""de_rows AS (
    SELECT {DE_REGION} AS region, (ts AT TIME ZONE 'Europe/Berlin') AT TIME ZONE 'UTC' AS ts,
           power_mw * 1000 AS solar_generation_kw
    FROM obs WHERE pct <> 0 AND event_type <> 'purchase'
    QUALIFY row_number() OVER (PARTITION BY event_type, ts ORDER BY power_mw DESC) = 1)"""


def de_areas(spark, sf_dir):
    obs = observations(spark, sf_dir)
    power = F.when(F.col("pct") != 0, F.col("power_mw"))
    headers = {
        "50hertz": {"Solar|Actual Aggregated": power, "Solar|Actual Consumption": F.col("pct")},
        "amprion": {"Solar": power, "Wind Onshore": F.col("pct")},
        "tennet": {"Wind Onshore|Actual Aggregated": power},
        "transnetbw": {
            "Solar|Actual Consumption": F.col("pct"),
            "Solar|Actual Aggregated": power,
            "Solar|Actual Aggregated.1": F.col("pct"),
        },
        "de": {"Solar|Actual Aggregated": power},
    }
    kinds = {region: kind for kind, region in DE_REGIONS.items()}
    return {
        region: obs.filter(F.col("event_type") == kinds[region]).select(
            F.col("ts").alias("ts_local"), *[col.alias(name) for name, col in header.items()]
        )
        for region, header in headers.items()
    }


@query(
    "de_generation",
    """SELECT ts AS target_datetime_utc, solar_generation_kw, capacity_kw, region,
              CASE region WHEN '50hertz' THEN '50Hertz' WHEN 'amprion' THEN 'Amprion'
                   WHEN 'tennet' THEN 'TenneT' WHEN 'transnetbw' THEN 'TransnetBW' END AS tso_zone
       FROM de_rows LEFT JOIN (
           SELECT region, arg_max(Solar, year_start) * 1000 AS capacity_kw FROM capacities
           WHERE Solar IS NOT NULL GROUP BY region) USING (region)
       WHERE ts >= TIMESTAMP '2023-12-31 09:00:00' AND ts <= TIMESTAMP '2024-01-31 09:00:00'""",
    OBS,
    CAPACITIES,
    DE_ROWS,
)
def de_generation(spark, sf_dir):
    """Areas with different headers, their newest capacity and operator."""
    return plans.de_generation(
        de_areas(spark, sf_dir),
        capacities(spark, sf_dir),
        "2024-01-31 09:41:00",
        backfill_hours=31 * 24,
    )


@query(
    "de_forecast",
    """SELECT ts AS target_datetime_utc, solar_generation_kw, 'de' AS region,
              'intraday' AS forecast_type
       FROM de_rows WHERE region = 'de'
         AND ts >= TIMESTAMP '2024-01-14 00:00:00' AND ts <= TIMESTAMP '2024-01-16 00:00:00'""",
    OBS,
    DE_ROWS,
)
def de_forecast(spark, sf_dir):
    """Today and tomorrow."""
    wide = de_areas(spark, sf_dir)["de"]
    return plans.de_forecast(wide, "intraday", "2024-01-14 09:41:00")


def ind_documents(spark, sf_dir):
    obs = observations(spark, sf_dir)
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")

    def item(name, power):
        record = F.struct(
            name.alias("scada_name"),
            power.cast("double").alias("Average2"),
            seconds.alias("SourceTimeSec"),
        )
        return F.struct(record.alias("0"), name.alias("scada_name"))

    solar = F.col("event_type").isin("view", "click")
    power = F.when(F.col("pct") < 5, -F.col("power_mw")).otherwise(F.col("power_mw"))
    items = F.array(
        item(F.lit("FREQUENCY"), F.lit(50.0)),
        item(F.when(solar, "SOLAR GEN").otherwise("WIND GEN"), power),
        item(F.lit("SOLAR GEN"), F.col("pct")),
    )
    return obs.select(F.to_json(F.struct(items.alias("data"))).alias("document"))


@query(
    "ind_generation",
    """SELECT energy_type, date_trunc('second', ts) AS target_datetime_utc,
              power * 1000 AS solar_generation_kw
       FROM (SELECT ts, CASE WHEN event_type IN ('view', 'click') THEN 'solar' ELSE 'wind' END
                    AS energy_type, CASE WHEN pct < 5 THEN -power_mw ELSE power_mw END AS power
             FROM obs
             UNION ALL
             SELECT ts, 'solar', CAST(pct AS DOUBLE) FROM obs
             WHERE event_type NOT IN ('view', 'click'))
       QUALIFY row_number() OVER (PARTITION BY energy_type, date_trunc('second', ts) ORDER BY power DESC) = 1
           AND power * 1000 >= 0""",
    OBS,
)
def ind_generation(spark, sf_dir):
    """First solar and wind record of each response, negative power dropped."""
    return plans.ind_generation(ind_documents(spark, sf_dir), "2024-01-31 00:00:00")


@query(
    "feed_dispatch_nl",
    "SELECT * FROM delivered",
    DAILY,
    NL_ROWS,
    NL_DELIVERED.replace("count(*) = 6", "count(*) = 13").format(
        rule=f"{NL_SETTLED} AND validfrom BETWEEN TIMESTAMP '1996-06-14 09:10:00' AND TIMESTAMP '1996-06-15 12:55:00'"
    ),
)
def feed_dispatch_nl(spark, sf_dir):
    """All Dutch responses landed by request date and region; here the set of regions is never complete."""
    landing = shared_folder(spark, "landing")
    documents = nl_documents(spark, sf_dir).repartition(64, "request_date")
    # the table's days have no time of the day, so documents are landed whole and the window cuts them
    documents.write.partitionBy("request_date", "region_id").text(f"{landing}/nl/generation")
    return plans.feed_dispatch("nl", "generation", FeedRun(spark, landing, "1996-06-15 13:10:00"))


@query("feed_dispatch_de", ORACLES["de_generation"])
def feed_dispatch_de(spark, sf_dir):
    """German areas landed as wide CSV files with headers of their own, one of them with repeated columns."""
    landing = shared_folder(spark, "landing")
    for region, wide in de_areas(spark, sf_dir).items():
        local = wide.withColumn("ts_local", F.date_format("ts_local", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        local.write.option("header", True).csv(f"{landing}/de/generation/{region}")
    capacities(spark, sf_dir).withColumn("year_start", F.col("year_start").cast("timestamp")).write.parquet(f"{landing}/de/capacity")
    run = FeedRun(spark, landing, "2024-01-31 09:41:00", backfill_hours=31 * 24)
    return plans.feed_dispatch("de", "generation", run)


@query(
    "feed_dispatch_ind",
    ORACLES["ind_generation"],
)
def feed_dispatch_ind(spark, sf_dir):
    """Landed responses of Rajasthan, polled twice."""
    landing = shared_folder(spark, "landing")
    for _ in range(2):
        ind_documents(spark, sf_dir).write.mode("append").text(f"{landing}/ind_rajasthan/generation")
    return plans.feed_dispatch("ind_rajasthan", "generation", FeedRun(spark, landing, "2024-01-31 00:00:00"))
