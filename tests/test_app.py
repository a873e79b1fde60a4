from __future__ import annotations

import json
from pathlib import Path
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from powerflow import plans, schemas
from powerflow.plans.app import Store
from powerflow.plans.dispatch import FeedRun
from powerflow.operators.curtailment import PRICE
from tests.conftest import at, rows
from tests.test_feeds import be_payload, member, overview
from tests.test_operators import GSP, gsp
from tests.test_stores import gb_registry

NOW = at("2026-01-18 09:10")


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


@pytest.fixture
def run(spark, tmp_path):
    return FeedRun(spark, str(tmp_path / "landing"), NOW)


def run_to(run, tmp_path, country, kind, sink):
    return plans.run_app(run, country, kind, sink, str(tmp_path / "store"), str(tmp_path / "out"))


def test_unknown_country_has_no_rows(run):
    empty = plans.feed_dispatch("fr", "generation", run)
    assert empty.count() == 0 and empty.columns == list(schemas.CONTRACT)
    with pytest.raises(ValueError, match="unknown kind"):
        plans.feed_dispatch("gb", "historic", run)


def test_errors_name_the_country(run):
    with pytest.raises(RuntimeError, match="generation of be failed"):
        plans.feed_dispatch("be", "generation", run)
    with pytest.raises(RuntimeError, match="forecast of ind_rajasthan failed"):
        plans.feed_dispatch("ind_rajasthan", "forecast", run)


def test_unknown_sink(run):
    with pytest.raises(ValueError, match="unknown sink"):
        plans.run_app(run, sink="ftp")


def test_belgium_to_csv_and_platform(spark, run, tmp_path):
    capacities, times = {"Wallonia": 16, "Belgium": 40}, [at(f"2026-01-18 {h:02}:00") for h in (5, 6, 7, 8)]
    put(tmp_path / "landing/be/forecast", "a.json", json.dumps(be_payload("mostrecentforecast", capacities, times)))
    assert run_to(run, tmp_path, "be", "forecast", "csv")
    written = spark.read.option("header", True).csv(str(tmp_path / "out/forecast_data.csv"))
    assert written.count() == 8
    put(tmp_path / "landing/be/generation", "a.json", json.dumps(be_payload("realtime", capacities, times)))
    for _ in range(2):
        assert run_to(run, tmp_path, "be", "generation", "data-platform")
    store = Store(spark, str(tmp_path / "store"))
    assert rows(store.observations(), "value_watts") == sorted((mw * t.hour * 62_500,) for t in times for mw in (16, 40))
    early = replace(run, now=at("2026-01-18 07:00"))
    for _ in range(2):
        assert run_to(early, tmp_path, "be", "forecast", "data-platform")
    values = spark.read.parquet(store.path("forecast_values"))
    assert rows(values, "forecaster_name", "horizon_mins", "p50_fraction") == [("elia_be_forecast", 0, 7 / 16)]


def test_nothing_landed_in_the_window_saves_nothing(run, tmp_path):
    put(tmp_path / "landing/be/generation", "a.json", json.dumps({"results": []}))
    assert not run_to(run, tmp_path, "be", "generation", "csv")
    assert not (tmp_path / "out").exists()


def test_netherlands_to_all_sinks(spark, run, tmp_path, frame):
    start = NOW - timedelta(hours=2)
    for region in range(13):
        capacity = 780 if region == 0 else 10 * region
        text = json.dumps({"hydra:member": [member(start, capacity=capacity, percentage=0.5)]})
        put(tmp_path / f"landing/nl/generation/request_date=2026-01-18/region_id={region}", "a.json", text)
    text = json.dumps({"hydra:member": [member(NOW + timedelta(hours=1), percentage=0.5)]})
    put(tmp_path / "landing/nl/forecast/request_date=2026-01-18/region_id=0", "a.json", text)
    frame([(start, -5.0)], f"target_datetime_utc timestamp, {PRICE} double").write.parquet(str(tmp_path / "landing/nl/prices"))

    potential = replace(run, potential=True)
    assert run_to(potential, tmp_path, "nl", "generation", "data-platform")
    store = Store(spark, str(tmp_path / "store"))
    observations = store.observations()
    assert rows(observations.groupBy("observer_name").count()) == [("nednl", 13), ("nednl_no_curtailment", 13)]
    largest = observations.groupBy("observer_name").agg(F.max("value_watts"))
    assert rows(largest) == [("nednl", 780_000), ("nednl_no_curtailment", 865_800)]
    assert dict(rows(store.locations(), "location_name", "effective_capacity_watts"))["nl_national"] == 1_560_000.0

    assert run_to(run, tmp_path, "nl", "generation", "site-db")
    assert spark.read.parquet(store.path("site_generation")).count() == 13
    assert run_to(run, tmp_path, "nl", "forecast", "site-db")
    forecast = spark.read.parquet(store.path("site_forecast_values")).first()
    assert (forecast["horizon_minutes"], forecast["timestamp_utc"]) == (70.0, at("2026-01-18 09:00"))
    assert spark.read.parquet(store.path("sites")).count() == 13
    assert run_to(run, tmp_path, "nl", "forecast", "data-platform")
    assert spark.read.parquet(store.path("forecast_values")).first()["horizon_mins"] == 70


def test_only_the_folders_of_the_window_are_read(spark, run, tmp_path):
    """Older responses are not opened, also not to tell which requests are missing."""
    start = NOW - timedelta(hours=2)
    for day in ("2025-12-31", "2026-01-17", "2026-01-18"):
        for region in range(13):
            text = json.dumps({"hydra:member": [member(start, capacity=780 if region == 0 else 10 * region, percentage=0.5)]})
            bad = day < "2026" or day == "2026-01-17" and region == 5
            if not (day == "2026-01-18" and region in (3, 7)):
                put(tmp_path / f"landing/nl/generation/request_date={day}/region_id={region}", "a.json", "" if bad else text)
    got = plans.feed_dispatch("nl", "generation", run)
    filters = got._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    assert "request_date" in filters.split("PushedFilters")[0]
    missing = plans.missing_requests(run)
    assert rows(missing) == [(at("2026-01-17").date(), 5), (at("2026-01-18").date(), 3), (at("2026-01-18").date(), 7)]
    plan = missing._jdf.queryExecution().executedPlan().toString()
    assert "request_date" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_great_britain_generation_and_forecast(spark, run, tmp_path, frame):
    landing = tmp_path / "landing/gb"
    data = [gsp(i, at("2026-01-18 09:00"), 1.0, updated=NOW) for i in (1, 350)]
    frame(data, GSP).write.parquet(str(landing / "generation"))
    frame([(1,), (4,), (350,)], "gsp_id int").write.parquet(str(landing / "registry"))
    package = {"result": {"resources": [{"path": "today.csv"}, {"path": "yesterday.csv"}]}}
    put(landing / "forecast/package", "p.json", json.dumps(package))
    put(landing / "forecast", "today.csv", "DATE_GMT,TIME_GMT,EMBEDDED_SOLAR_FORECAST\n2026-01-18T00:00:00,09:00,50\n2026-01-18T00:00:00,9:30,100\n")

    store = Store(spark, str(tmp_path / "store"))
    gb_registry(frame, [0, 1, 4], watts=1e9).write.parquet(store.path("location_registry"))
    assert run_to(run, tmp_path, "gb", "generation", "data-platform")
    assert rows(store.observations(), "location_uuid", "value_watts") == [("uuid-1", 1_000_000), ("uuid-4", 1_000_000)]
    assert rows(spark.read.parquet(store.path("observers"))) == [("pvlive_day_after",), ("pvlive_in_day",)]
    for _ in range(2):
        assert run_to(run, tmp_path, "gb", "forecast", "data-platform")
    values = spark.read.parquet(store.path("forecast_values"))
    assert rows(values, "horizon_mins", "p50_fraction") == [(0, 0.05), (30, 0.1)]
    assert spark.read.parquet(store.path("forecasters")).count() == 1
    with pytest.raises(ValueError, match="sites store"):
        run_to(run, tmp_path, "gb", "generation", "site-db")


def test_germany_from_wide_csv(spark, run, tmp_path, frame):
    landing = tmp_path / "landing/de"
    put(landing / "generation/50hertz", "a.csv", "ts_local,Wind Onshore|Actual Aggregated,Solar|Actual Aggregated\n2026-01-18 09:00:00,1,2.5\n2026-01-18 09:15:00,1,\n")
    put(landing / "generation/de", "a.csv", "ts_local,Solar\n2026-01-18 09:00:00,10\n")
    frame([("50hertz", at("2025-01-01"), 18.0)], "region string, year_start timestamp, Solar double").write.parquet(str(landing / "capacity"))
    got = plans.feed_dispatch("de", "generation", run)
    assert rows(got, "region", "target_datetime_utc", "solar_generation_kw", "capacity_kw") == [
        ("50hertz", at("2026-01-18 08:00"), 2500.0, 18_000.0), ("de", at("2026-01-18 08:00"), 10_000.0, None)
    ]
    put(landing / "forecast/current", "a.csv", "ts_local,Solar\n2026-01-18 11:00:00,10\n")
    later = replace(run, forecast_type="current")
    assert plans.feed_dispatch("de", "forecast", later).count() == 1
    for _ in range(2):
        assert run_to(run, tmp_path, "de", "generation", "site-db")
    store = Store(spark, str(tmp_path / "store"))
    assert rows(spark.read.parquet(store.path("sites")), "client_site_name", "capacity_kw") == [("50Hertz", 18_000)]
    assert spark.read.parquet(store.path("site_generation")).count() == 1
    assert run_to(run, tmp_path, "de", "generation", "data-platform")
    assert run_to(later, tmp_path, "de", "forecast", "data-platform")
    values = spark.read.parquet(store.path("forecast_values"))
    assert rows(values, "forecaster_name", "horizon_mins") == [("entsoe_de_current", 60)]


def test_overlapping_polls_are_stored_once(spark, run, tmp_path, frame):
    """The same key in three polls: the newest value counts, in sums and in the store."""
    records = [{"datetime": "2026-01-18T08:00:00Z", "region": "Belgium", "monitoredcapacity": 50, "realtime": v} for v in (4, 6, 9)]
    put(tmp_path / "landing/be/generation", "a.json", json.dumps({"results": records[:2]}) + "\n" + json.dumps({"results": records[2:]}))
    assert run_to(run, tmp_path, "be", "generation", "data-platform")
    assert rows(Store(spark, str(tmp_path / "store")).observations(), "value_watts") == [(9_000_000,)]

    data = [gsp(350, at("2026-01-18 09:00"), v, updated=NOW + timedelta(minutes=m)) for v, m in ((3.0, 1), (7.0, 9), (5.0, 4))]
    frame(data, GSP).write.parquet(str(tmp_path / "landing/gb/generation"))
    frame([(350,)], "gsp_id int").write.parquet(str(tmp_path / "landing/gb/registry"))
    got = plans.feed_dispatch("gb", "generation", run)
    assert dict(rows(got, "gsp_id", "solar_generation_kw"))[4] == 7000.0

    start = NOW - timedelta(hours=2)
    for region in range(13):
        polls = [json.dumps({"hydra:member": [member(start, capacity=780 if region == 0 else 10 * region, percentage=0.5, volume=v)]}) for v in (1, 2)]
        put(tmp_path / f"landing/nl/generation/request_date=2026-01-18/region_id={region}", "a.json", "\n".join(polls))
    got = plans.feed_dispatch("nl", "generation", run)
    assert got.count() == 13 and got.filter("NOT update_capacity").count() == 0


def test_responses_that_are_not_json(run, tmp_path):
    put(tmp_path / "landing/be/generation", "a.json", json.dumps({"results": []}) + '\n{"results": [')
    with pytest.raises(Exception, match="(?i)malformed"):
        plans.feed_dispatch("be", "generation", run).collect()
    assert plans.feed_dispatch("be", "generation", replace(run, on_error="drop")).count() == 0


def test_german_files_with_different_headers(run, tmp_path):
    folder = tmp_path / "landing/de/generation/de"
    put(folder, "a.csv", "ts_local,Solar,Wind\n2026-01-18 09:00:00,1,500\n")
    put(folder, "b.csv", "ts_local,Biomass,Solar\n2026-01-18 09:15:00,777,2\n2026-01-18 09:30:00,777,NaN\n")
    put(folder, "c.csv", "Solar|Actual Consumption,Solar|Actual Aggregated,ts_local\n9,3,2026-01-18 09:45:00\n")
    put(folder, "d.csv", "ts_local,Wind\n2026-01-18 10:00:00,3\n")
    got = plans.feed_dispatch("de", "generation", replace(run, now=at("2026-01-18 12:00")))
    assert [r[0] for r in rows(got.orderBy("target_datetime_utc"), "solar_generation_kw")] == [1000.0, 2000.0, 3000.0]


def test_landed_files_are_read_once(spark, run, tmp_path):
    """A run on a file that goes after the first reading."""
    records = [{"datetime": "2026-01-18T08:00:00Z", "region": "Belgium", "monitoredcapacity": 50, "realtime": 4}]
    put(tmp_path / "landing/be/generation", "a.json", json.dumps({"results": records}))
    from powerflow.session import shared_table

    with shared_table(plans.feed_dispatch("be", "generation", run), "test") as data:
        assert "json" not in data._jdf.queryExecution().executedPlan().toString().lower()
        path = data.inputFiles()[0]
    assert not Path(path.removeprefix("file://")).exists()


def test_germany_without_files(run):
    assert plans.feed_dispatch("de", "generation", run).count() == 0


def test_rajasthan(spark, run, tmp_path):
    put(tmp_path / "landing/ind_rajasthan/generation", "a.json", overview(("WIND GEN", 1.5, 1768728000), ("SOLAR GEN", 2.5, 1768728000)))
    assert run_to(run, tmp_path, "ind_rajasthan", "generation", "data-platform")
    assert run_to(run, tmp_path, "ind_rajasthan", "generation", "site-db")
    store = Store(spark, str(tmp_path / "store"))
    assert rows(store.observations(), "energy_source", "value_watts") == [("SOLAR", 2_500_000), ("WIND", 1_500_000)]
    assert rows(spark.read.parquet(store.path("sites")), "client_site_name", "capacity_kw") == [
        ("runvl_solar_site", 0), ("runvl_wind_site", 0)
    ]
