from __future__ import annotations

import json
from datetime import UTC, timedelta
from zoneinfo import ZoneInfo

import pytest

from powerflow import plans
from powerflow.operators.curtailment import POTENTIAL, PRICE
from powerflow.schemas import FEEDS
from powerflow.sources import load_weights
from tests.conftest import at, rows
from tests.test_operators import GSP, T0, T1, U7, gsp

NOW = at("2025-01-14 07:30")


def names(feed):
    return [target for _, target in FEEDS[feed]]


# --- Great Britain --------------------------------------------------------------------------------


def gb(spark, frame, data, ids, config, regime="in-day", now=NOW, **options):
    registry = frame([(i,) for i in ids], "gsp_id int")
    return plans.gb_generation(frame(data, GSP), registry, load_weights(spark, config), regime, now, **options)


def test_gb_units_and_columns(spark, frame):
    got = gb(spark, frame, [gsp(0, T0, 5.0)], [0, 1], {})
    assert got.columns == names("gb_generation")
    assert rows(got) == [(5000.0, T0, 90_000.0, 100_000.0, U7, "in-day", 0)]


def test_gb_ids_outside_the_registry_or_above_the_maximum(spark, frame):
    data = [gsp(i, T0, 1.0) for i in (0, 4, 348, 349)]
    got = gb(spark, frame, data, [0, 348, 349], {})
    assert rows(got, "gsp_id") == [(0,), (348,)]


def test_gb_target_in_the_registry_is_rebuilt_not_taken(spark, frame):
    data = [gsp(4, T0, 1.0), gsp(350, T0, 7.0), gsp(351, T0, 2.0)]
    got = gb(spark, frame, data, [4, 350], {4: [(350, 1.0), (351, 0.5)]})
    assert rows(got, "gsp_id", "solar_generation_kw") == [(4, 8000.0)]


def test_gb_target_above_the_maximum_is_left_out(spark, frame):
    assert gb(spark, frame, [gsp(1, T0, 1.0)], [], {400: [(1, 1.0)]}).count() == 0


def test_gb_area_without_capacity_enters_the_sums_as_zero_when_it_is_direct(spark, frame):
    data = [gsp(343, T0, 5.0, 0.0, 0.0), gsp(350, T0, 5.0, 0.0, 0.0), gsp(344, T0, 1.0)]
    config = {41: [(343, 1.0), (350, 1.0), (344, 1.0)]}
    got = dict(rows(gb(spark, frame, data, [343, 344], config), "gsp_id", "solar_generation_kw"))
    assert got == {343: 0.0, 344: 1000.0, 41: 6000.0}


def test_gb_missing_generation(spark, frame):
    data = [gsp(1, T0, None), gsp(1, T1, 2.0), gsp(2, T0, None), gsp(2, T1, float("nan"))]
    got = gb(spark, frame, data, [1, 2], {})
    assert rows(got, "gsp_id", "target_datetime_utc", "solar_generation_kw") == [
        (1, T1, 2000.0), (2, T0, None), (2, T1, None)
    ]


def test_gb_windows(spark, frame):
    times = [NOW - timedelta(hours=h) for h in (30, 10, 3, 2, 0)] + [NOW + timedelta(minutes=30)]
    data = [gsp(1, t, 1.0) for t in times]
    assert gb(spark, frame, data, [1], {}).count() == 3
    assert gb(spark, frame, data, [1], {}, backfill_hours=10).count() == 5
    assert gb(spark, frame, data, [1], {}, regime="day-after").count() == 1 + 1
    with pytest.raises(ValueError, match="unknown regime"):
        gb(spark, frame, data, [1], {}, regime="other")


def test_gb_forecast(frame):
    data = [("2025-01-14", f"0{h}:{m}", v) for (h, m), v in zip([(5, "30"), (6, "00"), (6, "30")], [7.0, 33.0, 250.0], strict=True)]
    got = plans.gb_forecast(frame(data + [("bad", "05:30", 1.0)], "DATE_GMT string, TIME_GMT string, EMBEDDED_SOLAR_FORECAST double"))
    assert rows(got) == [(at("2025-01-14 05:30"), 7_000.0), (at("2025-01-14 06:00"), 33_000.0), (at("2025-01-14 06:30"), 250_000.0)]


# --- Netherlands ----------------------------------------------------------------------------------


def member(start, minutes=15, updated=None, capacity=1000, percentage=50.0, volume=500):
    end = start + timedelta(minutes=minutes)
    return {
        "id": 1, "point": "/v1/points/0", "type": 2, "capacity": capacity, "volume": volume, "percentage": percentage,
        "validfrom": start.isoformat() + "+00:00", "validto": end.isoformat() + "+00:00",
        "lastupdate": (updated or end + timedelta(hours=1)).isoformat() + "+00:00",
    }


def nl_raw(frame, *responses):
    data = [(day, region, json.dumps({"hydra:member": members})) for day, region, members in responses]
    return frame(data, "request_date string, region_id int, document string")


def test_nl_generation_capacity_and_columns(frame):
    start = NOW - timedelta(hours=2)
    raw = nl_raw(frame, ("2025-01-14", 0, [member(start)]))
    got = plans.nl_generation(raw, NOW)
    assert got.columns == names("nl")
    row = got.first()
    assert (row["capacity_kw"], row["solar_generation_kw"], row["update_capacity"]) == (20.0, 1000.0, False)
    assert row["target_datetime_utc"] == start


def test_nl_generation_with_all_regions_updates_capacity(frame):
    start = NOW - timedelta(hours=2)
    regional = [("2025-01-14", i, [member(start, capacity=10 * i)]) for i in range(1, 13)]
    raw = nl_raw(frame, ("2025-01-14", 0, [member(start, capacity=780)]), *regional)
    got = plans.nl_generation(raw, NOW)
    assert rows(got, "update_capacity") == [(True,)] * 13
    small = nl_raw(frame, ("2025-01-14", 0, [member(start, capacity=780, percentage=0.001)]), *regional)
    assert {r[0] for r in rows(plans.nl_generation(small, NOW), "update_capacity")} == {False}


def test_nl_generation_window_and_settling(frame):
    yesterday = at("2025-01-13 00:30")
    inside = [yesterday, NOW - timedelta(minutes=15)]
    outside = [yesterday - timedelta(minutes=1), NOW - timedelta(minutes=14)]
    late = NOW + timedelta(hours=5)
    raw = nl_raw(frame, ("d", 0, [member(t, updated=late) for t in inside + outside]))
    assert [r[0] for r in rows(plans.nl_generation(raw, NOW), "target_datetime_utc")] == inside
    fresh = nl_raw(frame, ("d", 0, [member(NOW - timedelta(hours=1), updated=NOW - timedelta(minutes=30))]))
    assert plans.nl_generation(fresh, NOW).count() == 0
    assert plans.nl_forecast(fresh, NOW).count() == 1


def test_nl_settling_is_per_response(frame):
    start = NOW - timedelta(hours=2)
    late, early = start + timedelta(hours=1), start + timedelta(minutes=20)
    raw = nl_raw(frame, ("d", 0, [member(start, updated=late)]), ("d", 1, [member(start, updated=early)]))
    assert rows(plans.nl_generation(raw, NOW), "region_id") == [(0,)]


def test_nl_potential_generation(frame):
    start = NOW - timedelta(hours=2)
    raw = nl_raw(frame, ("d", 0, [member(start)]))
    prices = frame([(start, -1.0)], f"target_datetime_utc timestamp, {PRICE} double")
    got = plans.nl_generation(raw, NOW, prices)
    assert got.first()[POTENTIAL] == 1000 * 1.11
    assert plans.no_curtailment_variant(got).first()["solar_generation_kw"] == 1000 * 1.11


def test_nl_zero_percentage_has_no_capacity(frame):
    raw = nl_raw(frame, ("d", 0, [member(NOW - timedelta(hours=2), percentage=0.0)]))
    row = plans.nl_generation(raw, NOW).first()
    assert row["capacity_kw"] is None and row["update_capacity"] is False


# --- Belgium --------------------------------------------------------------------------------------


def be_raw(frame, *payloads):
    return frame([(json.dumps(p),) for p in payloads], "document string")


def be_payload(field, capacities, times):
    """A response with all regions at all times; power follows from the hour and the capacity."""
    return {"results": [
        {"datetime": t.isoformat() + "Z", "region": region, "monitoredcapacity": mw, field: mw * t.hour / 16}
        for t in times for region, mw in capacities.items()
    ]}


MIDSUMMER = [at(f"2025-06-21 {h:02}:00") for h in range(24)]


@pytest.mark.parametrize(("field", "plan", "kind"), [
    ("mostrecentforecast", plans.be_forecast, "most_recent"), ("realtime", plans.be_generation, "generation")
])
def test_be_regions_and_units(frame, field, plan, kind):
    raw = be_raw(frame, be_payload(field, {"BRUSSELS": 2, "Wallonia": 32, "\tLiège ": 4}, MIDSUMMER))
    got = plan(raw)
    assert got.columns == names("be")
    assert rows(got) == sorted(
        (t, 1000.0 * mw * t.hour / 16, region, kind, 1000.0 * mw)
        for t in MIDSUMMER for region, mw in (("brussels", 2), ("wallonia", 32), ("liège", 4))
    )
    other = plans.be_generation if plan is plans.be_forecast else plans.be_forecast
    assert other(raw).count() == 0


def test_be_incomplete_records_and_unexpected_payloads(frame):
    broken = {"results": [
        {"datetime": "no time", "realtime": 1.0, "region": "Belgium", "monitoredcapacity": 5},
        {"datetime": "2026-01-18T08:00:00Z", "realtime": None, "region": "Belgium", "monitoredcapacity": 5},
        {"datetime": "2026-01-18T08:00:00Z", "realtime": 1.0, "region": None, "monitoredcapacity": 5},
        {"datetime": "2026-01-18T08:00:00Z", "realtime": 1.0, "region": "Belgium"},
    ]}
    got = plans.be_generation(be_raw(frame, broken, {"results": []}, {"unexpected": []}))
    assert got.count() == 0 and got.columns == names("be")


def test_be_window(frame):
    raw = be_raw(frame, be_payload("mostrecentforecast", {"Belgium": 16}, MIDSUMMER))

    def hours(now, **options):
        return [t.hour for t, in rows(plans.be_forecast(raw, now, **options), "target_datetime_utc")]

    assert hours("2025-06-21 09:59") == list(range(10))
    assert hours("2025-06-22 20:00") == [20, 21, 22, 23]
    assert hours("2025-06-21 09:30", backfill_hours=2.5) == [7, 8, 9]


# --- Germany --------------------------------------------------------------------------------------


def wall_clock(frame, start, columns, *values):
    """A wide table of quarters of an hour from a UTC time on, by the clocks of the area."""
    times = [at(start) + timedelta(minutes=15 * i) for i in range(len(values))]
    local = [t.replace(tzinfo=UTC).astimezone(ZoneInfo("Europe/Berlin")).replace(tzinfo=None) for t in times]
    schema = "ts_local timestamp_ntz, " + ", ".join(f"c{i} double" for i in range(len(columns)))
    return frame([(t, *v) for t, v in zip(local, values, strict=True)], schema).toDF("ts_local", *columns)


CAPACITY = "region string, year_start timestamp, Solar double"
SPRING = "2025-03-30 00:30"  # half an hour before the clocks go forward


@pytest.mark.parametrize("columns", [
    ["Biomass", "Solar"], ["Solar|Actual Consumption", "Solar|Actual Aggregated"]
])
def test_de_generation_over_the_change_of_clocks(frame, columns):
    power = [0.25 * i for i in range(5)]
    areas = {
        region: wall_clock(frame, SPRING, columns, *[(7.0, factor * mw) for mw in power])
        for region, factor in (("tennet", 1), ("transnetbw", 4), ("de", 8))
    }
    newest = [("tennet", at("2019-01-01"), 3.0), ("tennet", at("2025-01-01"), 2.5), ("transnetbw", at("2023-01-01"), 9.0)]
    got = plans.de_generation(areas, frame(newest, CAPACITY), "2025-03-30 02:20")
    assert got.columns == names("de_generation")
    times = [at(SPRING) + timedelta(minutes=15 * i) for i in range(5)]
    assert rows(got, "region", "target_datetime_utc", "solar_generation_kw", "capacity_kw", "tso_zone") == [
        (region, t, 1000.0 * factor * mw, capacity, zone)
        for region, factor, capacity, zone in (
            ("de", 8, None, None), ("tennet", 1, 2500.0, "TenneT"), ("transnetbw", 4, 9000.0, "TransnetBW")
        )
        for t, mw in zip(times, power, strict=True)
    ]


def test_de_areas_without_solar_or_values_are_skipped(frame):
    areas = {
        "de": wall_clock(frame, SPRING, ["Hydro", "Nuclear"], (5.0, 6.0)),
        "tennet": wall_clock(frame, SPRING, ["Solar"], (None,), (float("nan"),)),
        "amprion": wall_clock(frame, SPRING, ["Solar"], (3.0,), (None,)),
    }
    got = plans.de_generation(areas, frame([], CAPACITY), "2025-03-30 09:00")
    assert rows(got, "region", "solar_generation_kw") == [("amprion", 3000.0)]
    with pytest.raises(ValueError, match="unknown areas"):
        plans.de_generation({"other": areas["de"]}, frame([], CAPACITY), NOW)


def test_de_window_ends_at_the_full_hour(frame):
    area = wall_clock(frame, SPRING, ["Solar"], *[(float(i),) for i in range(12)])

    def kept(**options):
        found = plans.de_generation({"de": area}, frame([], CAPACITY), "2025-03-30 02:59", **options)
        return [kw for kw, in rows(found.orderBy("target_datetime_utc"), "solar_generation_kw")]

    assert kept() == [1000.0 * i for i in range(7)]
    assert kept(backfill_hours=1) == [1000.0 * i for i in range(2, 7)]


@pytest.mark.parametrize("kind", ["day_ahead", "intraday", "current"])
def test_de_forecast_of_two_days(frame, kind):
    """Days are those of UTC, whatever the clocks say; autumn repeats an hour of them."""
    n = 4 * 24 * 3
    wide = wall_clock(frame, "2025-11-02 00:00", ["Wind Offshore", "Solar"], *[(1.0, float(i)) for i in range(n)])
    got = plans.de_forecast(wide, kind, "2025-11-02 17:45")
    assert got.columns == names("de_forecast")
    assert rows(got) == [
        (at("2025-11-02") + timedelta(minutes=15 * i), 1000.0 * i, "de", kind) for i in range(2 * 96 + 1)
    ]


def test_de_unknown_forecast(frame):
    with pytest.raises(ValueError, match="unknown forecast"):
        plans.de_forecast(wall_clock(frame, SPRING, ["Solar"], (1.0,)), "weekly", NOW)


# --- Rajasthan ------------------------------------------------------------------------------------


def overview(*records):
    return json.dumps({"data": [
        {"0": {"scada_name": n, "Average2": v, "SourceTimeSec": str(s)}, "scada_name": n, "value": v} for n, v, s in records
    ]})


def ind(frame, *documents):
    return plans.ind_generation(frame([(d,) for d in documents], "document string"), "2024-01-31 12:00:00")


def test_ind_generation(frame):
    document = overview(
        ("GRID HZ", 49.98, 1706695200), ("WIND GEN", 1.5, 1706695220), ("SOLAR GEN", 2.5, 1706695230), ("SOLAR GEN", 9.0, 1)
    )
    got = ind(frame, document)
    assert got.columns == names("ind_generation")
    assert rows(got) == [
        ("solar", at("2024-01-31 10:00:30"), 2500.0),
        ("wind", at("2024-01-31 10:00:20"), 1500.0),
    ]


def test_ind_missing_negative_and_stale_assets(frame):
    assert rows(ind(frame, overview(("WIND GEN", 1.0, 1))), "energy_type") == [("wind",)]
    assert ind(frame, overview(("TEST NEGATIVE", -100.0, 1))).count() == 0
    assert ind(frame, overview(("WIND GEN", -100.0, 1), ("WIND GEN", 5.0, 1))).count() == 0
    assert ind(frame, json.dumps({"data": []})).count() == 0
    from powerflow.plans.ind import ind_assets

    raw = frame([(overview(("WIND GEN", 1.0, 1), ("SOLAR GEN", 1.0, 1)),)], "document string")
    assert rows(ind_assets(raw, "2024-01-31"), "energy_type", "is_stale") == [("solar", False), ("wind", True)]


def test_ind_text_that_is_not_json(frame):
    with pytest.raises(Exception, match="(?i)malformed"):
        ind(frame, "<html>").collect()
