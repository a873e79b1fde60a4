from __future__ import annotations

import random
from datetime import timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from powerflow import operators as op
from powerflow.functions import number_tag, string_tag, tagged_map
from powerflow.operators.curtailment import POTENTIAL, PRICE
from powerflow.settings import NL_REGION_IDS, PROFILES
from powerflow.sources import load_weights
from tests.conftest import at, rows

GSP = "gsp_id int, datetime_gmt timestamp, generation_mw double, installedcapacity_mwp double, capacity_mwp double, updated_gmt timestamp"
T0, T1 = at("2025-01-14 06:00"), at("2025-01-14 06:30")
U7, U9 = at("2025-01-14 07:00"), at("2025-01-14 09:00")


# --- quality rules --------------------------------------------------------------------------------


def test_area_without_capacity_reports_zero(frame):
    df = frame([(1, 5.0, None), (1, None, 0.0), (2, 5.0, 1.0)], "k int, generation_mw double, capacity_mwp double")
    got = op.zero_gen_when_no_capacity(df, "k")
    assert rows(got, "k", "generation_mw") == [(1, 0.0), (1, 0.0), (2, 5.0)]


def test_missing_generation_stays_only_when_all_is_missing(frame):
    df = frame([(1, None), (1, 2.0), (2, None), (2, None)], "k int, generation_mw double")
    assert rows(op.drop_null_unless_all_null(df, "k")) == [(1, 2.0), (2, None), (2, None)]


def test_settled_areas_equal_both_rules_in_turn(frame):
    rng = random.Random(7)
    data = [
        (rng.randrange(12), rng.choice([None, 0.0, 1.5, 3.0]), rng.choice([None, 0.0, 0.0, 0.0, 2.0]))
        for _ in range(60)
    ] + [(20, None, None), (21, None, 1.0), (21, None, 1.0)]
    df = frame(data, "k int, generation_mw double, capacity_mwp double")
    two_steps = op.drop_null_unless_all_null(op.zero_gen_when_no_capacity(df, "k"), "k")
    assert rows(op.settle_areas(df, "k"), *df.columns) == rows(two_steps, *df.columns)

    expected = []
    for key, group in pd.DataFrame(data, columns=df.columns).groupby("k"):
        group = group.copy()
        if group["capacity_mwp"].sum() == 0:
            group["generation_mw"] = 0.0
        if not group["generation_mw"].isnull().all():
            group = group.dropna(subset=["generation_mw"])
        expected += [(key, None if pd.isna(g) else g) for g in group["generation_mw"]]
    got = rows(op.settle_areas(df, "k"), "k", "generation_mw")
    assert got == sorted(expected, key=lambda r: [(v is not None, v) for v in r])


def test_unsettled_rows_are_trimmed_strictly(frame):
    update = at("2025-01-14 10:00")
    df = frame(
        [("a", at("2025-01-14 09:44"), update), ("a", at("2025-01-14 09:45"), T0), ("b", at("2025-01-14 09:50"), at("2025-01-14 11:00"))],
        "batch string, validto timestamp, lastupdate timestamp",
    )
    assert rows(op.trim_unsettled(df, ["batch"]), "batch", "validto") == [
        ("a", at("2025-01-14 09:44")),
        ("b", at("2025-01-14 09:50")),
    ]


def test_value_filters_and_missing_values(frame):
    power = frame([(-1.0,), (0.0,), (None,)], "solar_generation_kw double")
    assert rows(op.drop_negative_power(power)) == [(None,), (0.0,)]
    capacity = frame([(0.0,), (5.0,), (None,)], "capacity_kw double")
    assert rows(op.drop_zero_capacity(capacity)) == [(None,), (5.0,)]
    both = frame(
        [(109.0, 100.0), (109.1, 100.0), (5.0, None), (None, 1.0)],
        "solar_generation_kw double, capacity_kw double",
    )
    limit = op.drop_over_capacity(both)
    assert rows(limit) == [(None, 1.0), (5.0, None), (109.0, 100.0)]
    share = frame([(0.001,), (0.01,), (None,)], "percentage double")
    assert rows(op.flag_small_percentage(share)) == [(None, True), (0.001, False), (0.01, True)]


def test_stale_rows_are_marked_and_kept(frame):
    df = frame(
        [("wind", at("2025-01-14 10:59")), ("wind", at("2025-01-14 11:00")), ("solar", at("2025-01-14 01:00"))],
        "energy_type string, target_datetime_utc timestamp",
    )
    flagged = op.flag_stale(df, "2025-01-14 12:00", "1 HOUR", F.col("energy_type") == "wind")
    assert sorted(r["is_stale"] for r in flagged.collect()) == [False, False, True]


def test_contract(frame):
    df = frame([(1,)], "a int")
    assert op.assert_contract(df, ["a"]) is df
    with pytest.raises(ValueError, match="solar_generation_kw"):
        op.assert_contract(df)


def test_grid_cells_that_are_missing(frame):
    ids = frame([(1,), (2,)], "k int")
    have = [(k, T0 + timedelta(minutes=30 * i)) for k in (1, 2) for i in range(36) if (k, i) != (2, 7)]
    df = frame(have, "k int, t timestamp")
    missing = op.grid_completeness(df, ids, T0, T0 + timedelta(minutes=30 * 35), "30 MINUTES", "t")
    assert rows(missing) == [(2, T0 + timedelta(minutes=210))]


# --- reconstruction -------------------------------------------------------------------------------


def gsp(i, t, generation, installed=100.0, capacity=90.0, updated=U7):
    return (i, t, generation, installed, capacity, updated)


def rebuild(spark, frame, data, config):
    return op.reconstruct_weighted(frame(data, GSP), load_weights(spark, config))


def test_two_sources_are_added_and_the_first_gives_the_update(spark, frame):
    data = [gsp(1, T0, 5.0), gsp(2, T0, 3.0, 50.0, 45.0, U9)]
    got = rebuild(spark, frame, data, {99: [(1, 1.0), (2, 1.0)]})
    assert rows(got, *GSP_COLUMNS) == [(99, T0, 8.0, 150.0, 135.0, U7)]
    swapped = rebuild(spark, frame, data, {99: [(2, 1.0), (1, 1.0)]})
    assert swapped.first()["updated_gmt"] == U9


GSP_COLUMNS = ("gsp_id", "datetime_gmt", "generation_mw", "installedcapacity_mwp", "capacity_mwp", "updated_gmt")


def test_weights_scale_all_measures(spark, frame):
    got = rebuild(spark, frame, [gsp(5, T0, 10.0)], {99: [(5, 0.5)]})
    assert rows(got, *GSP_COLUMNS) == [(99, T0, 5.0, 50.0, 45.0, U7)]


def test_missing_values_count_as_zero_and_a_missing_first_source_has_no_update(spark, frame):
    data = [gsp(1, T0, None, None, None), gsp(2, T1, 3.0, None, 45.0, U9)]
    got = rebuild(spark, frame, data, {99: [(1, 1.0), (2, 1.0)]})
    assert rows(got, *GSP_COLUMNS) == [(99, T0, 0.0, 0.0, 0.0, U7), (99, T1, 3.0, 0.0, 45.0, None)]


def test_a_source_may_serve_two_targets(spark, frame):
    got = rebuild(spark, frame, [gsp(351, T0, 100.0)], {56: [(351, 0.27)], 122: [(351, 0.73)]})
    assert rows(got, "gsp_id", "generation_mw") == [(56, 27.0), (122, 73.0)]
    assert rebuild(spark, frame, [gsp(1, T0, 1.0)], {7: []}).count() == 0


# --- capacity -------------------------------------------------------------------------------------


def regions(capacities, t, flag=True):
    return [(i, c, t, flag) for i, c in enumerate(capacities)]


CHECK = "region_id int, capacity_kw double, target_datetime_utc timestamp, update_capacity boolean"


def test_national_capacity_must_equal_the_regional_sum(frame):
    parts = [3.0 * i + 1 for i in range(1, 13)]
    total = sum(parts)
    cases = {
        at("2025-03-02 10:00"): ([total * 1.0009, *parts], True),
        at("2025-03-02 10:15"): ([total * 0.9991, *parts], True),
        at("2025-03-02 10:30"): ([total * 1.0011, *parts], False),
        at("2025-03-02 10:45"): ([total, *parts[:6], None, *parts[7:]], False),
        at("2025-03-02 11:00"): ([None, *parts], False),
    }
    data = [row for t, (values, _) in cases.items() for row in regions(values, t)]
    checked = op.validate_capacity(frame(data, CHECK), NL_REGION_IDS)
    assert checked.count() == len(data)
    got = {(r[0], r[1]) for r in rows(checked, "target_datetime_utc", "update_capacity")}
    assert got == {(t, good) for t, (_, good) in cases.items()}


def test_incomplete_repeated_or_unknown_regions_are_not_trusted(frame):
    partial = frame(regions([3.0, 1.0, 2.0], T0), CHECK).drop("update_capacity")
    assert {r[0] for r in rows(op.validate_capacity(partial, NL_REGION_IDS), "update_capacity")} == {False}
    twice = frame(regions([3.0, 1.0, 2.0], T0) + [(2, 2.0, T0, True)], CHECK)
    assert {r[0] for r in rows(op.validate_capacity(twice, [0, 1, 2]), "update_capacity")} == {False}
    unknown = frame([(0, 3.0, T0, True), (1, 1.0, T0, True), (9, 2.0, T0, True)], CHECK)
    assert {r[0] for r in rows(op.validate_capacity(unknown, [0, 1, 2]), "update_capacity")} == {False}


def test_tolerance_is_relative_to_the_national_value(frame):
    data = regions([1000.0, 1001.0], T0) + regions([1000.0, 1001.1], T1)
    got = op.national_vs_regional(frame(data, CHECK))
    assert rows(got, "target_datetime_utc", "is_close") == [(T0, True), (T1, False)]


def test_more_regions_than_bits(frame):
    ids = list(range(150))
    df = frame([(i, 1.0, T0) for i in ids] + [(i, 1.0, T1) for i in ids[:-1]] + [(0, 1.0, T1)],
               "region_id int, capacity_kw double, target_datetime_utc timestamp")
    assert rows(op.region_set_complete(df, ids)) == [(T0, True), (T1, False)]


UPDATES = "effective_capacity_watts double, new_effective_capacity_watts double, target_datetime_utc timestamp, location_uuid string"


def test_capacity_updates(frame):
    moves = {"less": 10.9, "just": 11.0, "down": 8.5, "none": None, "same": 10.0}
    df = frame([(10.0, new, T0, name) for name, new in moves.items()], UPDATES)
    assert rows(op.capacity_updates(df), "location_uuid") == [("down",), ("just",)]


def test_only_the_newest_capacity_counts(frame):
    df = frame([(0.0, 5e6, T0, "a"), (0.0, 10e6, T0, "a"), (0.0, 2e6, T1, "a")], UPDATES)
    assert rows(op.capacity_updates(df), "new_effective_capacity_watts") == [(2e6,)]
    tied = frame([(0.0, 5e6, T0, "a"), (0.0, 10e6, T0, "a")], UPDATES)
    assert rows(op.capacity_updates(tied), "new_effective_capacity_watts") == [(10e6,)]
    unchecked = df.withColumn("update_capacity", F.col("target_datetime_utc") == T0)
    assert rows(op.capacity_updates(unchecked), "new_effective_capacity_watts") == [(10e6,)]


def test_one_update_per_join_key(frame):
    df = frame([(0.0, 5.0, T0, "a"), (0.0, 7.0, T1, "b")], UPDATES).withColumn("join_key", F.lit(1))
    assert rows(op.capacity_updates(df), "location_uuid") == [("b",)]


def test_seeds_and_defaults(frame):
    df = frame([("a", 5.0, 10.0), ("a", 7.0, None), ("b", 3.9999, None), ("c", None, None)],
               "k string, solar_generation_kw double, capacity_kw double")
    assert rows(op.seed_capacity(df, "k")) == [("a", 10_000), ("b", 3_999)]
    bare = df.drop("capacity_kw")
    assert rows(op.seed_capacity(bare, "k")) == [("a", 7_000), ("b", 3_999)]
    by_key = op.max_generation_default(bare, "k")
    assert rows(by_key, "k", "capacity_kw") == [("a", 7.0), ("a", 7.0), ("b", 3.9999), ("c", None)]
    assert {r[0] for r in rows(op.max_generation_default(bare), "capacity_kw")} == {7.0}
    assert op.max_generation_default(df, "k") is df


def test_latest_capacity_in_any_row_order(frame):
    years = [(at("2023-01-01"), 18_000.0), (at("2025-01-01"), 20_000.0), (at("2024-01-01"), 19_000.0), (at("2026-01-01"), None)]
    for data in (years, years[::-1]):
        df = frame([("de", t, v) for t, v in data], "region string, year_start timestamp, Solar double")
        assert rows(op.latest_capacity(df, "region", "year_start")) == [("de", 20_000_000.0)]
        other = df.withColumnRenamed("Solar", "B16")
        assert rows(op.latest_capacity(other, "region", "year_start")) == [("de", 20_000_000.0)]


# --- curtailment ----------------------------------------------------------------------------------


def test_potential_generation_at_low_prices(frame):
    levels = {"10:00": 12.5, "11:00": 0.0, "12:00": -0.01, "13:00": 0.01, "14:00": -30.0}
    times = {at(f"2026-03-02 {hour}"): price for hour, price in levels.items()}
    unpriced = at("2026-03-02 15:00")
    df = frame([(t, 2.0) for t in [*times, unpriced]], "target_datetime_utc timestamp, solar_generation_kw double")
    prices = frame(list(times.items()), f"target_datetime_utc timestamp, {PRICE} double")
    got = dict(rows(op.potential_generation(df, prices), "target_datetime_utc", POTENTIAL))
    assert got == {**{t: 2.0 * 1.11 if price <= 0 else 2.0 for t, price in times.items()}, unpriced: 2.0}
    again = prices.union(frame([(at("2026-03-02 10:00"), 3.5)], prices.schema))
    assert op.potential_generation(df, again).count() == len(got)  # a price that was polled twice

    for refused in (prices.limit(0), prices.withColumn(PRICE, F.nullif(F.col(PRICE), F.lit(12.5)))):
        unchanged = op.potential_generation(df, refused)
        assert unchanged.count() == len(got)
        assert {r[0] for r in rows(unchanged, POTENTIAL)} == {2.0}


def test_rows_with_a_null_key_are_a_group(frame):
    df = frame([(None, 1.0), (None, 4.0), (1, 2.0)], "k int, v double")
    assert rows(op.max_over_key(df, "k", "v"), "v", "max_value") == [(1.0, 4.0), (2.0, 2.0), (4.0, 4.0)]


def test_newest_poll(frame):
    df = frame([(1, T0, 5.0), (1, T1, 3.0), (1, T1, 4.0), (2, None, 9.0), (2, T0, 1.0), (None, T0, 7.0)], "k int, t timestamp, v double")
    assert rows(op.newest_poll(df, "k", ["t", "landed"]), "k", "v") == [(None, 7.0), (1, 4.0), (2, 1.0)]


def test_zero_price_counts_as_low(frame):
    df = frame([(T0, 2.0)], "target_datetime_utc timestamp, solar_generation_kw double")
    prices = frame([(T0, 0.0)], f"target_datetime_utc timestamp, {PRICE} double")
    assert op.potential_generation(df, prices).first()[POTENTIAL] == 2.0 * 1.11


# --- matching -------------------------------------------------------------------------------------

PAIRS = "location_uuid string, target_datetime_utc timestamp"


def test_existing_rows_are_matched_on_location_and_time(frame):
    batch = frame([(u, t) for u in "ABC" for t in (T0, T1)], PAIRS)
    stored = frame([("A", T0), ("C", T0), ("C", T1)], PAIRS)
    assert rows(op.drop_existing(batch, stored, batch.columns)) == [("A", T1), ("B", T0), ("B", T1)]
    assert op.drop_existing(batch, stored.limit(0), batch.columns).count() == 6


def tagged(frame, data):
    df = frame(data, "location_name string, country string, region string, gsp_id int")
    tags = tagged_map(country=string_tag(F.col("country")), region=string_tag(F.col("region")), gsp_id=number_tag(F.col("gsp_id")))
    no_gsp = F.map_filter(tags, lambda k, v: v.getField("string_value").isNotNull() | v.getField("number_value").isNotNull())
    return df.select(F.concat(F.lit("id-"), "location_name").alias("location_uuid"), "location_name",
                     F.lit("SOLAR").alias("energy_source"), F.lit(1e6).alias("effective_capacity_watts"), no_gsp.alias("metadata"))


def test_countries_do_not_touch_each_other(frame):
    loc = tagged(frame, [("old", None, None, 1), ("gb", "gb", None, 2), ("nl", "nl", None, 3), ("blank", "", None, 4)])
    assert rows(op.country_isolation(loc, "gb"), "location_name") == [("blank",), ("gb",), ("old",)]
    assert rows(op.country_isolation(loc, "nl"), "location_name") == [("nl",)]


def test_locations_by_number(frame):
    loc = tagged(frame, [("one", "gb", None, 1), ("none", "gb", None, None)])
    df = frame([(1, 2.0), (1, None), (1, 0.0), (99, 2.0)], "gsp_id int, capacity_kw double")
    joined = op.join_locations(df, loc, PROFILES["gb"])
    assert rows(joined, "location_uuid", "new_effective_capacity_watts") == [("id-one", None), ("id-one", 2000.0)]
    assert rows(op.unmatched_keys(df, loc, PROFILES["gb"])) == [(99,)]


def test_locations_by_text_fall_back_to_the_name(frame):
    loc = tagged(frame, [("be_belgium", "be", " Belgium ", None), ("Flanders", "be", None, None)])
    df = frame([("belgium", 1.0), ("flanders", 1.0), ("wallonia", 1.0)], "region string, capacity_kw double")
    joined = op.join_locations(df, loc, PROFILES["be"])
    assert rows(joined, "region", "location_name") == [("belgium", "be_belgium"), ("flanders", "Flanders")]


def test_clashing_location_columns_are_renamed(frame):
    loc = tagged(frame, [("one", "gb", None, 1)])
    df = frame([(1, 2.0, "mine")], "gsp_id int, capacity_kw double, location_name string")
    joined = op.join_locations(df, loc, PROFILES["gb"])
    assert rows(joined, "location_name", "location_name_loc") == [("mine", "one")]


def test_lists_are_compared_as_multisets(frame):
    a = frame([(1,), (1,), (2,)], "k int")
    b = frame([(1,), (2,), (3,)], "k int")
    assert rows(op.registry_equality(a, b)) == [(1, 1), (3, -1)]
    assert op.registry_equality(a, a).count() == 0


def test_names_targets_and_members(spark, frame):
    left = frame([("x", 1.0)], "GSPs string, v double")
    names = frame([("x", 7)], "gsp_name string, gsp_id int")
    assert op.join_name_map(left, names, "GSPs", "gsp_name").columns == ["v", "gsp_name", "gsp_id"]
    ids = frame([(4,), (5,)], "gsp_id int")
    assert rows(op.exclude_merge_targets(ids, load_weights(spark, {4: [(5, 1.0)]}))) == [(5,)]
    assert rows(op.missing_members(ids, frame([(4,)], "gsp_id int"), "gsp_id")) == [(5,)]
    assert rows(op.set_difference(ids.union(ids), frame([(4,)], "gsp_id int"), "gsp_id")) == [(5,)]


def test_union_by_name(frame):
    got = op.union_feeds(frame([(1, "a")], "x int, y string"), frame([(2,)], "x int"))
    assert rows(got) == [(1, "a"), (2, None)]


# --- series and totals ----------------------------------------------------------------------------


def test_aggregated_series_is_preferred(frame):
    wide = frame([(T0, 1.0, 9.0, 5.0), (T1, None, 9.0, 5.0)], "t timestamp, a double, b double, c double").toDF(
        "t", "Solar|Actual Consumption", "Wind Onshore|Actual Aggregated", "Solar|Actual Aggregated"
    )
    assert rows(op.pick_series(wide, ["t"])) == [(T0, 5.0), (T1, 5.0)]
    twice = wide.toDF("t", "Solar", "Wind", "Solar.1")
    assert rows(op.pick_series(twice, ["t"])) == [(T0, 1.0)]
    none = wide.toDF("t", "Hydro", "Wind", "Gas")
    assert rows(op.pick_series(none, ["t"])) == []
    only_consumption = wide.toDF("t", "Solar|Actual Consumption", "Wind|Actual Aggregated", "Gas|Actual Aggregated")
    assert rows(op.pick_series(only_consumption, ["t"])) == []


def test_payloads_are_bounded_and_ordered(frame):
    data = [("a", T0 + timedelta(seconds=i), i) for i in range(250)]
    data += [("a", T0 + timedelta(hours=1), 99)] * 40 + [("b", T0 + timedelta(seconds=i), i) for i in (2, 1)]
    df = frame(data, "location_uuid string, timestamp_utc timestamp, value_watts bigint")
    payloads = op.collect_observations(df, ["location_uuid"], max_values=50).collect()
    got = {(r["location_uuid"], r["slot_start"], r["part"]): [(v["watts"], v["copies"]) for v in r["values"]] for r in payloads}
    assert got[("a", T0 + timedelta(hours=1), 0)] == [(99, 40)]
    assert got[("b", T0, 0)] == [(1, 1), (2, 1)]
    split = [values for (k, t, _), values in got.items() if (k, t) == ("a", T0)]
    assert len(split) == 5
    assert all(values == sorted(values) for values in split)
    assert sorted(v for values in split for v in values) == [(i, 1) for i in range(250)]
    plan = op.collect_observations(df, ["location_uuid"], max_values=50)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # to count the values and to gather them


def test_summaries(frame):
    df = frame([("a", T0, 1.0), ("a", T0, None), ("b", T1, 3.0)], "k string, t timestamp, v double")
    assert rows(op.run_summary(df, "k", "t", "v")) == [("a", 2, 1, 1.0, 1, T0, T0), ("b", 1, 1, 3.0, 1, T1, T1)]
    assert rows(op.time_extent(df, "t")) == [(T0, T1)]
    assert rows(op.distinct_keys(df, "k")) == [("a", 2), ("b", 1)]
    assert rows(op.duplicate_timestamps(df, ["k", "t"])) == [("a", T0, 2)]


def test_cube(frame):
    df = frame([(T0, "a", 1.0, 2.0), (T1, "b", 3.0, 4.0)], "t timestamp, k string, g double, c double")
    cube = op.pivot_cube(df, "t", "k", ["g", "c"], ["a", "b"])
    assert cube.columns == ["t", *op.cube_columns(["a", "b"], ["g", "c"])]
    assert rows(cube) == [(T0, 1.0, 2.0, None, None), (T1, None, None, 3.0, 4.0)]
    with pytest.raises(Exception, match="several rows"):
        op.pivot_cube(df.union(df), "t", "k", ["g", "c"], ["a", "b"]).collect()


# --- dimensions -----------------------------------------------------------------------------------

SITES = "client_site_name string, country string, latitude double, longitude double, capacity_kw bigint"
WANTED = "client_site_name string, latitude double, longitude double, capacity_override_kw bigint"


def test_site_defaults_by_country(frame):
    stored = frame([("nl_national", "nl", 52.13, 5.29, 5)], SITES)
    wanted = frame([("nl_national", 52.13, 5.29, 9), ("TenneT", 1.0, 2.0, None), ("TenneT2", 1.0, 2.0, 7)], WANTED)
    got = {c: dict(rows(op.get_or_create_site(stored, wanted, c), "client_site_name", "capacity_kw")) for c in ("nl", "de", "ind_rajasthan")}
    assert got["nl"] == {"nl_national": 5, "TenneT": 20_000_000, "TenneT2": 7}
    assert got["de"]["TenneT"] == 21_882_000
    assert got["ind_rajasthan"]["TenneT"] == 0


def test_site_capacity_moves_up_and_down(frame):
    stored = frame([(n, "nl", 0.0, 0.0, 10) for n in "abcd"], SITES)
    overrides = frame([("a", 12), ("b", 8), ("c", 10)], "client_site_name string, capacity_override_kw bigint")
    got = rows(op.update_site_capacity(stored, overrides), "client_site_name", "capacity_kw", "is_updated")
    assert got == [("a", 12, True), ("b", 8, True), ("c", 10, False), ("d", 10, False)]


def test_forecaster_actions(frame):
    schema = "name string, version string"
    stored = frame([("a", "1"), ("a", "2"), ("b", "1")], schema)
    got = op.upsert_forecaster(stored, frame([("a", "2"), ("b", "2"), ("c", "1")], schema))
    assert rows(got, "name", "action") == [("a", "reuse"), ("b", "new_version"), ("c", "create")]


def test_newest_history_is_applied(spark, frame):
    from powerflow.schemas import CAPACITY_HISTORY

    loc = tagged(frame, [("one", "gb", None, 1), ("two", "gb", None, 2)]).withColumn("valid_from_utc", F.lit(T0))
    tags = {"k": (1.0, None)}
    history = spark.createDataFrame([("id-one", "SOLAR", 5, T0, tags), ("id-one", "SOLAR", 7, T1, tags)], CAPACITY_HISTORY)
    now = op.current_locations(loc, history)
    assert rows(now, "location_name", "effective_capacity_watts", "valid_from_utc") == [("one", 7.0, T1), ("two", 1e6, T0)]
