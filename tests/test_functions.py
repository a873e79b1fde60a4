from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from powerflow import functions as pf
from tests.conftest import at, rows


def test_units_truncate_toward_zero_and_keep_missing(frame):
    df = frame([(1.9999,), (-1.9999,), (None,), (float("nan"),)], "kw double")
    watts = [r[0] for r in df.select(pf.kw_to_watts(F.col("kw"))).collect()]
    assert watts == [1999, -1999, None, None]
    assert [r[0] for r in df.select(pf.mw_to_kw(F.col("kw"))).collect()][:2] == [1999.9, -1999.9]


def test_capacity_from_percentage_without_percentage(frame):
    df = frame([(10.0, 0.5), (10.0, 0.0), (0.0, 0.0)], "p double, f double")
    got = [r[0] for r in df.select(pf.capacity_from_percentage(F.col("p"), F.col("f"))).collect()]
    assert got == [20.0, None, None]


def test_p50_fraction_refuses_capacity_that_is_not_positive(frame):
    df = frame([(100.0, 1_000_000.0), (500.0, 1_000_000.0)], "kw double, w double")
    fractions = [r[0] for r in df.select(pf.p50_fraction(F.col("kw"), F.col("w"))).collect()]
    assert fractions == [0.1, 0.5]
    bad = frame([(100.0, 0.0)], "kw double, w double")
    with pytest.raises(Exception, match="capacity must be positive"):
        bad.select(pf.p50_fraction(F.col("kw"), F.col("w"))).collect()


@pytest.mark.parametrize(
    ("date", "time", "expected"),
    [
        ("2025-01-14T00:00:00", "05:30", at("2025-01-14 05:30")),
        ("2025-01-14", " 5:30 ", at("2025-01-14 05:30")),
        ("2025-01-14", "25:00", None),
        ("nonsense", "05:30", None),
        (None, "05:30", None),
    ],
)
def test_parse_date_time(frame, date, time, expected):
    df = frame([(date, time)], "d string, t string")
    assert df.select(pf.parse_date_time(F.col("d"), F.col("t"))).first()[0] == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2026-01-18T08:00:00+00:00", at("2026-01-18 08:00")),
        ("2026-01-18T08:00:00+01:00", at("2026-01-18 07:00")),
        ("2026-01-18T08:00Z", at("2026-01-18 08:00")),
        ("yesterday", None),
    ],
)
def test_parse_iso_utc(frame, text, expected):
    assert frame([(text,)], "t string").select(pf.parse_iso_utc(F.col("t"))).first()[0] == expected


def test_local_time_in_summer_and_winter(frame):
    df = frame([("2025-07-11 02:00",), ("2025-01-11 02:00",)], "t string")
    got = df.select(pf.local_to_utc(F.col("t").cast("timestamp_ntz"), "Europe/Berlin")).collect()
    assert [r[0] for r in got] == [at("2025-07-11 00:00"), at("2025-01-11 01:00")]


def test_floor_time_keeps_the_type(frame):
    df = frame([(at("2025-01-14 13:47:12.5"),)], "t timestamp").withColumn(
        "n", F.col("t").cast("timestamp_ntz")
    )
    for minutes, text in [(15, "13:45"), (30, "13:30"), (60, "13:00"), (1440, "00:00")]:
        floored = df.select(
            pf.floor_time(F.col("t"), minutes).alias("t"),
            pf.floor_time(F.col("n"), minutes).alias("n"),
        )
        assert [f.dataType.simpleString() for f in floored.schema] == ["timestamp", "timestamp_ntz"]
        assert set(floored.first()) == {at(f"2025-01-14 {text}")}
    with pytest.raises(ValueError, match="does not divide"):
        pf.floor_time(F.col("t"), 7)


def test_utc_literal_reaches_the_scan(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    frame([(at("2025-01-14 13:00"),)], "t timestamp").withColumn(
        "n", F.col("t").cast("timestamp_ntz")
    ).write.parquet(path)
    limit = pf.utc_literal("2025-01-14T14:00:00+01:00")
    for name in ("t", "n"):
        kept = spark.read.parquet(path).filter(F.col(name) >= limit)
        assert f"GreaterThanOrEqual({name}" in kept._jdf.queryExecution().toString()
        assert kept.count() == 1


def test_horizon_truncates_before_the_past_is_dropped(frame):
    df = frame(
        [(at("2025-01-14 11:59:30"),), (at("2025-01-14 11:59:00"),), (at("2025-01-14 12:30"),)],
        "target_datetime_utc timestamp",
    )
    dated = pf.forecast_horizon(df, pf.utc_literal("2025-01-14 12:00"))
    assert rows(dated, "horizon_minutes", "horizon_mins") == [(-1.0, -1), (-0.5, 0), (30.0, 30)]
    assert rows(pf.drop_past_horizon(dated), "horizon_mins") == [(0,), (30,)]


def test_names(frame):
    df = frame([("in-day", "solar", "neso-solar-forecast", "day_ahead")], "r string, e string, t string, k string")
    got = df.select(
        pf.derive_names("observer", F.col("r")),
        pf.derive_names("asset", F.col("e")),
        pf.derive_names("forecaster", F.col("t")),
        pf.derive_names("de_forecaster", F.col("k")),
    ).first()
    assert tuple(got) == ("pvlive_in_day", "ruvnl_solar", "neso_solar_forecast", "entsoe-de-day-ahead")
    with pytest.raises(ValueError, match="unknown kind"):
        pf.derive_names("other", F.col("r"))


def test_metadata_keeps_text_and_sets_one_number(frame):
    df = frame([("Area", 4)], "name string, id int").select(
        pf.tagged_map(full_name=pf.string_tag(F.col("name")), gsp_id=pf.number_tag(F.col("id"))).alias("m")
    )
    key = "capacity_no_degradation_kw"
    merged = df.select(pf.merge_metadata(F.col("m"), key, F.lit(2200.9)).alias("m"))
    again = merged.select(pf.merge_metadata(F.col("m"), key, F.lit(5.0)).alias("m")).first()["m"]
    assert {k: (v["number_value"], v["string_value"]) for k, v in again.items()} == {
        "full_name": (None, "Area"),
        "gsp_id": (4.0, None),
        key: (5.0, None),
    }
    value = merged.select(pf.metadata_value(F.col("m"), key, "number")).first()[0]
    assert value == 2200.0
    assert merged.select(pf.metadata_value(F.col("m"), "country", "string")).first()[0] is None


def test_merge_metadata_of_nothing(frame):
    df = frame([(1,)], "x int").select(F.lit(None).cast("map<string,struct<number_value:double,string_value:string>>").alias("m"))
    merged = df.select(pf.merge_metadata(F.col("m"), "k", F.lit(3.0)).alias("m")).first()["m"]
    assert merged["k"]["number_value"] == 3.0


def test_lookup_wkt_and_key(frame):
    df = frame([(" DE ", 5.29, 52.13)], "k string, lon double, lat double")
    got = df.select(
        pf.lookup_map(pf.normalise_key(F.col("k")), {"de": "DE"}),
        pf.lookup_map(F.col("k"), {"de": "DE"}),
        pf.point_wkt(F.col("lon"), F.col("lat")),
    ).first()
    assert tuple(got) == ("DE", None, "POINT(5.29 52.13)")


def test_float32(frame):
    df = pf.cast_float32(frame([(1 / 3,)], "v double"), ["v"])
    assert df.schema["v"].dataType.simpleString() == "float"
    assert math.isclose(df.first()[0], 1 / 3, rel_tol=1e-6)
