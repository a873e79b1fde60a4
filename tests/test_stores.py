from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from powerflow import plans, schemas, sinks
from powerflow.functions import metadata_value, number_tag, string_tag, tagged_map
from powerflow.operators import seed_capacity, seed_locations
from powerflow.plans.app import Store, run_platform_generation, run_site_generation
from powerflow.settings import PROFILES
from powerflow.sources import on_days, packaged_locations, read_table, site_table
from tests.conftest import at, rows

T0, T1 = at("2025-01-14 12:00"), at("2025-01-14 12:30")
GB = PROFILES["gb"]
FACTS = "gsp_id int, regime string, capacity_kw double, capacity_no_degradation_kw double, solar_generation_kw double, target_datetime_utc timestamp"


def gb_registry(frame, ids, watts=1e6, kind="GSP", extra=None):
    df = frame([(i,) for i in ids], "id int")
    tags = {"gsp_id": number_tag(F.col("id")), "full_name": string_tag(F.concat(F.lit("area "), "id"))}
    return df.select(
        F.concat(F.lit("uuid-"), "id").alias("location_uuid"),
        F.concat(F.lit("gsp "), "id").alias("location_name"),
        F.lit("SOLAR").alias("energy_source"),
        F.when(F.col("id") == 0, "NATION").otherwise(kind).alias("location_type"),
        F.lit(None).cast("string").alias("geometry_wkt"),
        F.lit(watts).alias("effective_capacity_watts"),
        tagged_map(**tags).alias("metadata"),
        F.lit(at("2020-01-01")).alias("valid_from_utc"),
    )


def save(spark, frame, data, registry, stored=()):
    existing = spark.createDataFrame(list(stored), schemas.OBSERVATIONS)
    return plans.save_generation(frame(data, FACTS), registry, existing, GB)


def test_above_capacity_is_dropped_and_capacity_updated(spark, frame):
    data = [(1, "in-day", 2000.0, 2200.0, 100.0, T0), (1, "in-day", 2000.0, 2200.0, 3000.0, T1)]
    saved = save(spark, frame, data, gb_registry(frame, [1]))
    assert rows(saved.observations) == [("uuid-1", "SOLAR", "pvlive_in_day", T0, 100_000)]
    update = saved.capacity.first()
    assert (update["new_effective_capacity_watts"], update["valid_from_utc"]) == (2_000_000, T1)
    tags = {k: tuple(v) for k, v in update["metadata"].items()}
    assert tags["full_name"] == (None, "area 1")
    assert tags["capacity_no_degradation_kw"] == (2200.0, None)


def test_unknown_ids_and_zero_capacity(spark, frame):
    data = [(99, "in-day", 5.0, 5.0, 1.0, T0), (1, "in-day", 0.0, 0.0, 1.0, T0)]
    saved = save(spark, frame, data, gb_registry(frame, [1]))
    assert saved.observations.count() == 0 and saved.capacity.count() == 0


def test_observer_follows_the_regime_of_each_row(spark, frame):
    data = [(1, "in-day", 1000.0, 1.0, 1.0, T0), (1, "day-after", 1000.0, 1.0, 1.0, T0)]
    saved = save(spark, frame, data, gb_registry(frame, [1]))
    assert rows(saved.observations, "observer_name") == [("pvlive_day_after",), ("pvlive_in_day",)]
    assert saved.capacity.count() == 0


def test_stored_observations_are_not_stored_again(spark, frame):
    data = [(i, "in-day", 1000.0, 1.0, 1.0, t) for i in (1, 2) for t in (T0, T1)]
    stored = [("uuid-1", "SOLAR", "pvlive_in_day", T0, 5), ("uuid-2", "SOLAR", "pvlive_day_after", T0, 5)]
    saved = save(spark, frame, data, gb_registry(frame, [1, 2]), stored)
    assert rows(saved.observations, "location_uuid", "timestamp_utc") == [
        ("uuid-1", T1), ("uuid-2", T0), ("uuid-2", T1)
    ]


def test_missing_generation_is_not_stored(spark, frame):
    saved = save(spark, frame, [(1, "in-day", 1000.0, 1.0, None, T0)], gb_registry(frame, [1]))
    assert saved.observations.count() == 0


def test_locations_are_seeded_for_a_country(spark, frame):
    made = seed_locations(packaged_locations(spark, "nl"), None, PROFILES["nl"])
    assert made.count() == 13
    assert rows(made.select("location_uuid").distinct()).__len__() == 13
    national = made.filter("location_name = 'nl_national'").first()
    assert national["geometry_wkt"] == "POINT(5.29 52.13)"
    assert national["location_type"] == "NATION"
    assert national["effective_capacity_watts"] == 100_000_000
    facts = frame([(0, 5.0, 10.0), (1, 7.0, None)], "region_id int, solar_generation_kw double, capacity_kw double")
    seeded = seed_locations(packaged_locations(spark, "nl"), seed_capacity(facts, "region_id"), PROFILES["nl"])
    number = metadata_value(F.col("metadata"), "region_id", "number")
    got = dict(rows(seeded, number, "effective_capacity_watts"))
    assert (got[0.0], got[1.0], got[2.0]) == (10_000.0, 7_000.0, 1e8)


def test_rajasthan_without_capacity_gets_two_locations(spark, frame, tmp_path):
    store = Store(spark, str(tmp_path))
    data = frame([("solar", 1500.0, T0), ("wind", 800.0, T0)], "energy_type string, solar_generation_kw double, target_datetime_utc timestamp")
    run_platform_generation(store, data, PROFILES["ind_rajasthan"])
    assert rows(store.observations(), "energy_source", "observer_name", "value_watts") == [
        ("SOLAR", "ruvnl", 1_500_000), ("WIND", "ruvnl", 800_000)
    ]
    assert rows(store.locations(), "location_name", "effective_capacity_watts") == [
        ("ruvnl_solar", 1_500_000.0), ("ruvnl_wind", 800_000.0)
    ]


def test_german_regions_are_stored_once(spark, frame, tmp_path):
    store = Store(spark, str(tmp_path))
    regions = ["de", "50hertz", "amprion", "tennet", "transnetbw"]
    data = frame(
        [(r, at(f"2025-01-14 1{h}:00"), 100.0, 1000.0) for r in regions for h in range(3)],
        "region string, target_datetime_utc timestamp, solar_generation_kw double, capacity_kw double",
    )
    for _ in range(2):
        run_platform_generation(store, data, PROFILES["de"])
    assert store.observations().count() == 15
    assert read_table(spark, store.path("observers"), schemas.OBSERVERS).count() == 1
    assert {r[0] for r in rows(store.locations(), "effective_capacity_watts")} == {1_000_000.0}


def test_nothing_matching_is_an_error_but_no_capacity_is_not(spark, frame, tmp_path):
    schema = "region string, target_datetime_utc timestamp, solar_generation_kw double, capacity_kw double"
    store = Store(spark, str(tmp_path))
    with pytest.raises(ValueError, match="NonExistentRegion"):
        run_platform_generation(store, frame([("NonExistentRegion", T0, 1.0, 2.0)], schema), PROFILES["be"])
    run_platform_generation(store, frame([("nowhere", T0, 1.0, 0.0)], schema), PROFILES["be"])
    run_platform_generation(store, frame([], schema), PROFILES["be"])
    assert store.observations().count() == 0


FORECAST = "target_datetime_utc timestamp, solar_generation_kw double"


def test_forecast_fractions_and_horizons(frame):
    data = frame([(T0, 100.0), (T1, 500.0), (at("2025-01-14 11:00"), 9.0)], FORECAST)
    values = plans.save_forecast(data, gb_registry(frame, [0, 1]), GB, "neso-solar-forecast", "1.0", T0)
    assert rows(values) == [
        ("neso_solar_forecast", "1.0", "uuid-0", "SOLAR", T0, 0, 0.1),
        ("neso_solar_forecast", "1.0", "uuid-0", "SOLAR", T0, 30, 0.5),
    ]


def test_forecast_needs_a_national_location_with_capacity(frame):
    data = frame([(T0, 100.0)], FORECAST)
    with pytest.raises(ValueError, match="no national location"):
        plans.save_forecast(data, gb_registry(frame, [1]), GB, "t", "1", T0)
    with pytest.raises(ValueError, match="capacity 0.0"):
        plans.save_forecast(data, gb_registry(frame, [0], watts=0.0), GB, "t", "1", T0)


SITE_FACTS = "region_id int, target_datetime_utc timestamp, solar_generation_kw double, capacity_kw double"


def sites(spark, frame, data, country="nl", key="region_id", schema=SITE_FACTS, stored=()):
    known = spark.createDataFrame(list(stored), schemas.SITE_REGISTRY)
    return plans.site_generation(frame(data, schema), site_table(spark, country, schemas.SITES), known, key, country)


def test_one_site_with_the_largest_capacity(spark, frame):
    saved = sites(spark, frame, [(0, T0, 100.0, 20_000_000.0), (0, T1, 150.0, 20_000_002.0), (77, T0, 1.0, 1.0)])
    assert saved.rows.count() == 2
    assert rows(saved.sites, "client_site_name", "capacity_kw") == [("nl_national", 20_000_002)]


def test_site_default_capacity(spark, frame):
    saved = sites(spark, frame, [(0, T0, 100.0, None)])
    assert rows(saved.sites, "client_site_name", "capacity_kw") == [("nl_national", 20_000_000)]


def test_rajasthan_sites(spark, frame):
    schema = "energy_type string, target_datetime_utc timestamp, solar_generation_kw double, capacity_kw double"
    saved = sites(spark, frame, [("solar", T0, 1.0, 500.0), ("wind", T0, 2.0, 600.0)], "ind_rajasthan", "energy_type", schema)
    assert rows(saved.sites, "client_site_name", "capacity_kw") == [("runvl_solar_site", 500), ("runvl_wind_site", 600)]
    assert rows(saved.rows, "energy_type", "power_kw") == [("solar", 1.0), ("wind", 2.0)]


def test_german_sites_ignore_national_rows(spark, frame):
    schema = "tso_zone string, target_datetime_utc timestamp, solar_generation_kw double"
    saved = sites(spark, frame, [(None, T0, 1.0), ("TenneT", T0, 2.0)], "de", "tso_zone", schema)
    assert rows(saved.sites, "client_site_name", "capacity_kw") == [("TenneT", 21_882_000)]
    assert rows(saved.rows, "power_kw", "energy_type") == [(2.0, "solar")]


def test_site_forecast(frame):
    got = plans.site_forecast(frame([(T1, 100.0)], FORECAST), "nl_national", "m", "1", "2025-01-14 12:07:30")
    row = got.first()
    assert (row["horizon_minutes"], row["timestamp_utc"], row["end_utc"]) == (30.0, T0, at("2025-01-14 12:45"))


def test_csv(spark, frame, tmp_path):
    df = frame([(2, "x"), (1, "y")], "a int, _sa_instance_state string")
    path = sinks.write_csv(df, str(tmp_path), ["a"])
    assert path.endswith("forecast_data.csv")
    assert rows(spark.read.option("header", True).csv(path)) == [("1",), ("2",)]
    assert sinks.write_csv(df.limit(0), str(tmp_path / "none")) is None
    assert not (tmp_path / "none").exists()
    with pytest.raises(ValueError, match="folder"):
        sinks.write_csv(df, "")


def test_cube_is_not_overwritten(frame, tmp_path):
    df = frame([(T0, 1.0)], "t timestamp, a double")
    sinks.write_cube(df, str(tmp_path / "c"), "t", overwrite=False)
    with pytest.raises(Exception, match="(?i)already exists"):
        sinks.write_cube(df, str(tmp_path / "c"), "t", overwrite=False)
    sinks.write_cube(df, str(tmp_path / "c"), "t", overwrite=True)


def test_observations_are_partitioned(spark, frame, tmp_path):
    path = str(tmp_path / "obs")
    data = [("a", "SOLAR", "o", T0, 1), ("a", "SOLAR", "o", at("2025-01-15 00:00"), 2)]
    sinks.append_observations(spark.createDataFrame(data, schemas.OBSERVATIONS), path)
    assert sorted(p.name for p in (tmp_path / "obs" / "observer_name=o").iterdir()) == ["date=2025-01-14", "date=2025-01-15"]


def forecast_rows(frame, version, run, hours):
    data = frame([(at(f"2025-01-14 {h:02}:00"), float(h)) for h in hours], FORECAST)
    return plans.site_forecast(data, "nl_national", "model", version, run)


def test_a_forecast_run_is_replaced_as_a_whole(spark, frame, tmp_path):
    path, run = str(tmp_path / "forecasts"), ["client_site_name", "ml_model_name", "forecast_version"]

    def store(version, when, hours, bad=False):
        values = forecast_rows(frame, version, when, hours)
        if bad:
            values = values.withColumn("forecast_power_kw", F.raise_error(F.lit("lost")).cast("double"))
        sinks.append_forecast(values, path, "timestamp_utc", run)

    def held():
        stored = spark.read.schema(schemas.SITE_FORECAST_STORED).parquet(path)
        return rows(stored.groupBy("forecast_version", "timestamp_utc").count())

    store("1", "2025-01-14 12:00", range(13, 20))
    store("1", "2025-01-14 12:15", range(13, 16))
    store("2", "2025-01-14 12:00", range(13, 15))
    before = [("1", T0, 7), ("1", at("2025-01-14 12:15"), 3), ("2", T0, 2)]
    assert held() == before
    store("1", "2025-01-14 12:10", range(13, 20))  # the same quarter of an hour is the same run
    assert held() == before
    with pytest.raises(Exception, match="lost"):
        store("1", "2025-01-14 12:00", range(13, 15), bad=True)
    assert held() == before
    store("1", "2025-01-14 12:00", ())
    assert held() == before
    store("1", "2025-01-14 12:00", range(13, 15))
    assert held() == [("1", T0, 2), *before[1:]]


def test_storing_a_run_reads_no_stored_run(spark, frame, tmp_path):
    path = tmp_path / "forecasts"
    sinks.append_forecast(forecast_rows(frame, "1", "2025-01-14 12:00", (13,)), str(path), "timestamp_utc")
    for file in path.rglob("*.parquet"):
        file.write_bytes(b"spoilt")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    sinks.append_forecast(forecast_rows(frame, "1", "2025-01-14 12:30", (14,)), str(path), "timestamp_utc")
    sinks.append_forecast(forecast_rows(frame, "1", "2025-01-14 12:00", (13, 15)), str(path), "timestamp_utc")
    stored = spark.read.schema(schemas.SITE_FORECAST_STORED).parquet(str(path))
    assert stored.count() == 3
    plan = stored.filter("init_date = DATE '2025-01-14' AND run = '20250114T123000Z'")
    assert "run#" in plan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    assert plan.count() == 1


def test_sites_read_the_days_of_their_batch(spark, frame, tmp_path):
    store = Store(spark, str(tmp_path))

    def save_days(*days):
        data = frame([(0, at(f"2025-01-{day:02} 12:00"), 1.0, 5.0) for day in days], SITE_FACTS)
        run_site_generation(store, data, "nl", T0)

    save_days(10, 11, 12)
    table = tmp_path / "site_generation"
    for day in (10, 12):
        for file in (table / f"date=2025-01-{day}").glob("*.parquet"):
            file.write_bytes(b"spoilt")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    save_days(11, 14)
    for day in (11, 14):
        assert spark.read.parquet(str(table / f"date=2025-01-{day}")).count() == 1
    stored = on_days(store.read("site_generation", schemas.SITE_GENERATION_STORED), [T0.date()])
    filters = stored._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    assert "date#" in filters.split("PushedFilters")[0]
    assert on_days(stored, []).count() == 0


GSP = "gsp_id int, datetime_gmt timestamp, generation_mw double, capacity_mwp double"


def gsp_cube(frame, data, ids=(1, 2), known=(1, 2)):
    lists = [frame([(i,) for i in part], "gsp_id int") for part in (known, ids)]
    return plans.backfill_gsp_cube(frame(data, GSP), lists[0], lists[1], T0, T1)


def test_gsp_cube(frame):
    full = [(i, t, float(i), 2.0) for i in (1, 2) for t in (T0, T1)]
    cube = gsp_cube(frame, full)
    assert cube.columns == ["time_utc", "1_generation_mw", "1_capacity_mwp", "2_generation_mw", "2_capacity_mwp"]
    assert rows(cube) == [(T0, 1.0, 2.0, 2.0, 2.0), (T1, 1.0, 2.0, 2.0, 2.0)]
    with pytest.raises(ValueError, match="duplicate"):
        gsp_cube(frame, full + full[:1])
    with pytest.raises(ValueError, match="missing times"):
        gsp_cube(frame, full[:-1])
    with pytest.raises(ValueError, match="lists of areas"):
        gsp_cube(frame, full, known=(1, 3))


def test_cubes_show_every_location(frame):
    data = [(1, T0, 1.0, 2.0), (1, T1, 1.0, 2.0), (5, T0, 1.0, 2.0)]
    with pytest.raises(ValueError, match="areas that are not in the list"):
        gsp_cube(frame, data, ids=(1,), known=(1,))
    regional = frame([(T0, "Namur", 1.0, 5.0)], "datetime timestamp, region string, realtime double, monitoredcapacity double")
    with pytest.raises(ValueError, match="regions that are not in the list"):
        plans.backfill_regional_cube(regional, T0, T1, ["Liege"], "realtime")


def test_regional_cube_is_half_open_and_32_bit(frame):
    data = [(t, r, 1 / 3, 5.0) for t in (T0, T1) for r in ("Belgium", "Namur")]
    df = frame(data, "datetime timestamp, region string, realtime double, monitoredcapacity double")
    cube = plans.backfill_regional_cube(df, T0, T1, ["Belgium", "Namur"], "realtime")
    assert [r[0] for r in rows(cube, "time_utc")] == [T0]
    assert {f.dataType.simpleString() for f in cube.schema if f.name != "time_utc"} == {"float"}
