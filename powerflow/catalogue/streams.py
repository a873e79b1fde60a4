"""Streaming ingest, driven over the landed files until everything has been processed."""

from __future__ import annotations

from pyspark.sql import functions as F

from powerflow.catalogue.inputs import FACTS, HOME, LOC, OBS, REG, TABLES, locations, registry, table
from powerflow.catalogue.registry import query
from powerflow.catalogue.rules import SETTLING
from powerflow.catalogue.stores import JOINED
from powerflow.functions import kw_to_watts
from powerflow.session import shared_folder
from powerflow.sinks import append_rows
from powerflow.streaming import (
    run_available,
    stream_enrich_guard,
    stream_ingest,
    stream_settled,
)


def landed_events(spark, sf_dir):
    """The events table as a stream. A pattern, because the table may be one file or a folder."""
    return spark.readStream.schema(TABLES["events"]).parquet(f"{sf_dir}/events.parquet*")


@query(
    "stream_ingest",
    """SELECT user_id, event_type, ts, max(CAST(trunc(value * 1000) AS BIGINT)) AS watts,
              ts::DATE AS date FROM events GROUP BY ALL""",
)
def ingest(spark, sf_dir):
    """Two overlapping polls, a first run of one and a later run of both, stored once each."""
    folder = shared_folder(spark, "ingest")

    def poll():
        return landed_events(spark, sf_dir).select(
            "user_id",
            F.col("event_type").alias("observer_name"),
            "ts",
            kw_to_watts(F.col("value")).alias("watts"),
        )

    schema = "user_id bigint, observer_name string, ts timestamp_ntz, watts bigint, date date"
    for number, stream in enumerate([poll(), poll().union(poll())]):
        stream_ingest(
            stream,
            f"{folder}/store",
            f"{folder}/checkpoint-{number}",
            keys=("user_id", "observer_name", "ts"),
            ts="ts",
            schema=schema,
        ).awaitTermination()
    stored = spark.read.schema(schema).parquet(f"{folder}/store")
    return stored.withColumnRenamed("observer_name", "event_type")


@query("stream_enrich_guard", "SELECT * FROM fresh", OBS, LOC, FACTS, REG, JOINED)
def enrich_guard(spark, sf_dir):
    """The batch join and rules on a stream."""
    folder = shared_folder(spark, "enriched")
    published = F.when(F.col("c_mktsegment") != "BUILDING", F.col("capacity_mw") * 1000)
    capacity = locations(spark, sf_dir).select(
        F.col("location_id").alias("gsp_id"), published.alias("capacity_kw")
    )
    kind = F.col("event_type")
    stream = landed_events(spark, sf_dir).select(
        F.col("user_id").alias("gsp_id"),
        F.col("ts").alias("target_datetime_utc"),
        (F.col("value") * 1000).alias("solar_generation_kw"),
        F.when(kind.isin("view", "click"), "in-day").otherwise("day-after").alias("regime"),
    ).join(capacity, "gsp_id")
    guarded = stream_enrich_guard(stream, registry(spark, sf_dir), HOME)

    def write(batch, _):
        append_rows(batch, f"{folder}/store")

    run_available(guarded, write, f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/store")


@query(
    "stream_settled",
    """SELECT event_id, location_id, validto, lastupdate FROM (
           SELECT *, max(lastupdate) OVER (PARTITION BY request_date, location_id) AS latest
           FROM settling) WHERE validto < latest - INTERVAL 15 MINUTE""",
    OBS,
    SETTLING,
)
def settled(spark, sf_dir):
    """Settled rows of landed responses, one file in each micro-batch, and the same files polled again."""
    folder = shared_folder(spark, "settled")
    minutes = F.make_dt_interval(mins=F.from_json("props", "k INT").getField("k"))
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("location_id"),
        F.to_date("ts").alias("request_date"),
        F.col("ts").alias("validto"),
        (F.col("ts") + minutes).alias("lastupdate"),
    )
    # a response holds the readings of a location and day, and is one row of a landed file
    record = F.struct("event_id", "validto", "lastupdate")
    responses = rows.groupBy("request_date", "location_id").agg(F.collect_list(record).alias("records"))
    responses.repartition(4, "location_id").write.parquet(f"{folder}/landed")
    schema = "event_id bigint, location_id bigint, validto timestamp_ntz, lastupdate timestamp_ntz"
    for number in range(2):
        landed = spark.readStream.schema(responses.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/landed")
        latest = F.array_max(F.transform("records", lambda r: r.getField("lastupdate")))
        stream = landed.select("location_id", latest.alias("response_update"), F.inline("records"))
        stream_settled(
            stream, f"{folder}/store", f"{folder}/checkpoint-{number}", ["event_id"], schema
        ).awaitTermination()
    return spark.read.schema(f"{schema}, date date").parquet(f"{folder}/store").drop("date")
