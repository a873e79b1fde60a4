from __future__ import annotations

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from powerflow import sources
from powerflow.settings import GB_MERGE_WEIGHTS
from tests.conftest import at, rows


def documents(frame, *texts):
    return frame([(t if isinstance(t, str) else json.dumps(t),) for t in texts], "document string")


@pytest.mark.parametrize(
    ("path", "document"),
    [
        ("results[]", {"results": [{"v": 1}, {"v": 2}]}),
        ("hydra:member[]", {"hydra:member": [{"v": 1}, {"v": 2}]}),
        ("result.records[]", {"result": {"records": [{"v": 1}, {"v": 2}]}}),
        ("data[].0", {"data": [{"0": {"v": 1}}, {"0": {"v": 2}}]}),
    ],
)
def test_envelopes(frame, path, document):
    flat = sources.flatten_records(documents(frame, document), path, "v int")
    assert rows(flat) == [(0, 1), (1, 2)]


def test_missing_and_empty_arrays_have_no_rows(frame):
    flat = sources.flatten_records(
        documents(frame, {"results": []}, {"unexpected": []}, "not json"), "results[]", "v int"
    )
    assert rows(flat) == []
    assert flat.columns == ["pos", "v"]


def test_text_that_is_not_json_is_an_error_when_strict(frame):
    flat = sources.flatten_records(
        documents(frame, "not json"), "data[].0", "v int", strict=True
    )
    with pytest.raises(Exception, match="(?i)malformed"):
        flat.collect()


def test_csv_columns_by_name(spark, tmp_path):
    (tmp_path / "f.csv").write_text(
        "SETTLEMENT,EMBEDDED_SOLAR_FORECAST,TIME_GMT,DATE_GMT\n1,12.5, 05:30,2025-01-14T00:00:00\n"
    )
    df = sources.read_feed_csv(spark, str(tmp_path))
    assert rows(df) == [("2025-01-14T00:00:00", " 05:30", 12.5)]


def test_latest_resource_and_newest_path(frame):
    def package(*paths):
        return json.dumps({"result": {"resources": [{"path": p} for p in paths]}})

    df = frame([("a", 1, package("one.csv", "old.csv")), ("a", 2, package("two.csv")), ("b", 1, package())],
               "k string, modified int, document string")
    named = sources.latest_resource(df)
    assert rows(named, "k", "path") == [("a", "one.csv"), ("a", "two.csv"), ("b", None)]
    assert rows(sources.newest_path(named, ["k"], "path", ["modified"])) == [("a", "two.csv"), ("b", None)]


def test_packaged_locations(spark):
    assert sources.packaged_locations(spark, "nl").count() == 13
    assert rows(sources.packaged_locations(spark, "ind_rajasthan"), "name", "energy_source") == [
        ("ruvnl_solar", "solar"),
        ("ruvnl_wind", "wind"),
    ]


def test_locations_from_csv(spark, tmp_path):
    path = str(tmp_path / "locations")
    for country in ("nl", "be", "de", "ind_rajasthan"):
        known = sources.packaged_locations(spark, country)
        known.write.mode("append").option("header", True).csv(path)
    for country in ("nl", "ind_rajasthan"):
        assert rows(sources.read_locations(spark, path, country)) == rows(
            sources.packaged_locations(spark, country)
        )


def test_weights_from_mapping_and_files(spark, tmp_path):
    assert sources.load_weights(spark).count() == sum(map(len, GB_MERGE_WEIGHTS.values()))
    config = {"4": {"pvlive_merge_weights": [{"gsp_id": 324}, {"gsp_id": 325, "weight": 0.5}]}, "7": {}}
    path = tmp_path / "w.json"
    path.write_text(json.dumps(config))
    assert rows(sources.load_weights(spark, str(path))) == [(4, 324, 1.0, 0), (4, 325, 0.5, 1)]
    assert sources.load_weights(spark, str(tmp_path / "missing.json")).count() == 0
    (tmp_path / "empty.json").write_text("")
    assert sources.load_weights(spark, str(tmp_path / "empty.json")).count() == 0


def test_weights_from_yaml(spark, tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "w.yaml"
    path.write_text("139:\n  pvlive_merge_weights:\n    - gsp_id: 323\n    - gsp_id: 334\n      weight: 1.0\n")
    assert rows(sources.load_weights(spark, str(path))) == [(139, 323, 1.0, 0), (139, 334, 1.0, 1)]


def test_negative_weights_are_refused(spark, frame):
    with pytest.raises(ValueError, match="negative weight"):
        sources.load_weights(spark, {4: [(1, -1.0)]})
    table = frame([(4, 1, -1.0, 0)], "target int, source int, weight double, pos int")
    with pytest.raises(Exception, match="negative weight"):
        sources.load_weights(spark, table).collect()


def test_chunks_by_step_are_clipped(spark):
    chunks = sources.time_chunks(spark, "2020-01-01", "2020-01-12", step=timedelta(days=5))
    assert rows(chunks, "chunk_start", "chunk_end") == [
        (at("2020-01-01"), at("2020-01-06")),
        (at("2020-01-06"), at("2020-01-11")),
        (at("2020-01-11"), at("2020-01-12")),
    ]
    assert sources.time_chunks(spark, "2020-01-01", "2020-01-06", step=timedelta(days=5)).count() == 1
    assert sources.time_chunks(spark, "2020-01-01", "2020-01-01", step=timedelta(days=5)).count() == 0


def test_equal_chunks_round_up_to_the_half_hour(spark):
    chunks = sources.time_chunks(spark, "2020-01-01", "2020-01-02", n=7)
    starts = [r[0] for r in sorted(tuple(r) for r in chunks.select("chunk_start").collect())]
    assert starts[1] == at("2020-01-01 03:30")
    assert len(starts) == 7
    assert all(s.minute in (0, 30) for s in starts)


@pytest.mark.parametrize(
    ("feed", "first", "last"),
    [
        ("gb_in-day", "2025-06-10 10:20", "2025-06-10 12:50"),
        ("gb_day-after", "2025-06-09 00:00", "2025-06-09 23:30"),
        ("nl_generation", "2025-06-09 00:20", "2025-06-10 12:05"),
        ("nl_forecast", "2025-06-10 10:20", "2025-06-17 12:20"),
        ("de_generation", "2025-06-09 12:00", "2025-06-10 12:00"),
        ("de_forecast", "2025-06-10 00:00", "2025-06-12 00:00"),
        ("be", "2025-06-09 12:20", "2025-06-10 12:20"),
    ],
)
def test_feed_windows(feed, first, last):
    assert sources.feed_window(feed, "2025-06-10 12:20") == (at(first), at(last))


def test_window_sides(frame):
    df = frame([(at("2025-01-01"),), (at("2025-01-02"),), (at("2025-01-03"),)], "t timestamp")
    assert sources.time_window(df, "t", "2025-01-01", "2025-01-02").count() == 2
    assert sources.time_window(df, "t", "2025-01-01", "2025-01-02", closed="left").count() == 1


def test_existing_observations_prune_dates(spark, frame, tmp_path):
    path = str(tmp_path / "obs")
    schema = "location_uuid string, observer_name string, timestamp_utc timestamp, date date"
    stored = [("A", "o", at(f"2025-01-{d:02d} 12:00"), at(f"2025-01-{d:02d}").date()) for d in range(1, 11)]
    stored += [("A", "p", at("2025-01-09 12:00"), at("2025-01-09").date()),
               ("B", "o", at("2025-01-09 12:00"), at("2025-01-09").date())]
    frame(stored, schema).write.partitionBy("observer_name", "date").parquet(path)
    batch = frame([("A", at("2025-01-08 00:00"))], "location_uuid string, target_datetime_utc timestamp")
    table = sources.read_table(spark, path, schema)
    found = sources.read_existing_observations(table, batch, "o", "2025-01-09 23:00")
    assert [r[0].day for r in sorted(found.select("timestamp_utc").collect())] == [8, 9]
    assert "date" in str(found._jdf.queryExecution().executedPlan().toString()).split("PartitionFilters")[1]


def test_table_that_was_never_written(spark, tmp_path):
    assert sources.read_table(spark, str(tmp_path / "nothing"), "a int").count() == 0


def test_sql_feed(frame, spark):
    feed = frame(
        [("2025-01-14", "05:30", 101.0), ("2025-01-14", "06:00", 200.0), ("bad", "06:30", 1.0)],
        "DATE_GMT string, TIME_GMT string, EMBEDDED_SOLAR_FORECAST double",
    )
    got = sources.sql_feed(spark, feed, "SELECT * FROM feed")
    assert rows(got, "solar_generation_kw") == [(101.0,), (200.0,)]
    scaled = sources.sql_feed(spark, feed, "SELECT * FROM feed LIMIT 1", scale=1000.0)
    assert scaled.first()["solar_generation_kw"] == 101_000.0
    for broken in ("SELEC 1", "SELECT nothing FROM nowhere", "SELECT 1 AS x FROM feed"):
        empty = sources.sql_feed(spark, feed, broken)
        assert empty.count() == 0
        assert empty.columns == ["target_datetime_utc", "solar_generation_kw"]


def test_ids(frame):
    ids = frame([(1,), (348,), (349,), (1,)], "gsp_id int")
    assert rows(sources.list_active_ids(ids, 348)) == [(1,), (348,)]
    assert sources.cap_ids(ids, None).count() == 4


def test_documents_skip_files_from_before_the_window(spark, tmp_path):
    import os

    for name, when in (("old", "2025-01-01"), ("new", "2025-02-01")):
        file = tmp_path / f"{name}.json"
        file.write_text(name)
        os.utime(file, (at(when + " 00:00:00+00:00").timestamp(),) * 2)
    assert sources.read_documents(spark, str(tmp_path)).count() == 2
    docs = sources.read_documents(spark, str(tmp_path), modified_after=at("2025-01-15"))
    assert [r["document"] for r in docs.select(F.col("document")).collect()] == ["new"]


def test_documents_by_line_and_request_date(spark, tmp_path):
    for day in ("2025-01-01", "2025-01-14"):
        folder = tmp_path / f"request_date={day}"
        folder.mkdir()
        (folder / "a.json").write_text(f'{{"d": "{day}"}}\n\n{{"d": 2}}\n')
    docs = sources.read_documents(spark, str(tmp_path), since=at("2025-01-10").date())
    assert sorted(r["document"] for r in docs.collect()) == ['{"d": "2025-01-14"}', '{"d": 2}']
    assert docs.first()["landed"] is not None


def test_csv_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("DATE_GMT,TIME_GMT,EMBEDDED_SOLAR_FORECAST\n2025-01-14,05:30,1\n")
    (tmp_path / "b.csv").write_text('\ufeffnote,EMBEDDED_SOLAR_FORECAST,TIME_GMT,DATE_GMT\r\n"a, ""b""",2,06:00,2025-01-14\r\n')
    got = rows(sources.read_feed_csv(spark, str(tmp_path)))
    assert got == [("2025-01-14", "05:30", 1.0), ("2025-01-14", "06:00", 2.0)]
    (tmp_path / "c.csv").write_text("DATE_GMT,TIME_GMT\n2025-01-14,05:30\n")
    with pytest.raises(Exception, match="no column EMBEDDED_SOLAR_FORECAST"):
        sources.read_feed_csv(spark, str(tmp_path)).collect()


def test_chunks_shorter_than_half_an_hour(spark):
    chunks = sources.time_chunks(spark, "2020-01-01 00:10", "2020-01-01 03:10", n=100)
    found = sorted(map(tuple, chunks.select("chunk_no", "chunk_start", "chunk_end").collect()))
    starts = [at("2020-01-01 00:30") + timedelta(minutes=30 * i) for i in range(6)]
    assert found == [(i, s, s + timedelta(minutes=30)) for i, s in enumerate(starts)]
    assert "Window" not in chunks._jdf.queryExecution().executedPlan().toString()
    assert sources.time_chunks(spark, "2020-01-01", "2020-01-01", n=4).count() == 0


def test_equal_chunks_meet_for_any_number(spark):
    for n in (1, 3, 47, 48, 49, 1000):
        chunks = sources.time_chunks(spark, "2020-01-01 00:00:01", "2020-01-02 00:00:01", n=n)
        found = sorted(map(tuple, chunks.select("chunk_no", "chunk_start", "chunk_end").collect()))
        assert [row[0] for row in found] == list(range(min(n, 48)))
        assert found[0][1] == at("2020-01-01 00:30") and found[-1][2] == at("2020-01-02 00:30")
        assert all(a[2] == b[1] for a, b in zip(found, found[1:], strict=False))


def test_a_large_csv_file_is_split(spark, tmp_path):
    """One long file over many tasks, beside a short one with another header; headers are found by file."""
    n = 40_000
    body = "".join(f"{i},{i // 60 % 24:02}:{i % 60:02},2025-01-14\n" for i in range(n))
    (tmp_path / "long.csv").write_text("\n  \nEMBEDDED_SOLAR_FORECAST,TIME_GMT,DATE_GMT\n" + body)
    (tmp_path / "short.csv").write_text("DATE_GMT,TIME_GMT,EMBEDDED_SOLAR_FORECAST\n2025-01-14,05:30,-1\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("DATE_GMT,TIME_GMT,EMBEDDED_SOLAR_FORECAST\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        feed = sources.read_feed_csv(spark, str(tmp_path))
        assert feed.rdd.getNumPartitions() >= 8
        total = feed.agg(F.count(F.lit(1)), F.sum("EMBEDDED_SOLAR_FORECAST"), F.min("DATE_GMT"), F.max("DATE_GMT")).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert tuple(total) == (n + 1, n * (n - 1) / 2 - 1, "2025-01-14", "2025-01-14")


def test_a_year_of_five_minute_chunks(spark):
    chunks = sources.time_chunks(spark, "2024-01-01", "2025-01-01", step=timedelta(minutes=5))
    assert chunks.count() == 366 * 288
    last = chunks.orderBy(F.desc("chunk_no")).first()
    assert last["chunk_end"] == at("2025-01-01") and last["chunk_start"] == at("2024-12-31 23:55")


def test_weights_by_uri(spark, tmp_path):
    path = tmp_path / "w.json"
    path.write_text('{"9": [[20, 0.5]]}')
    assert rows(sources.load_weights(spark, f"file://{path}")) == rows(sources.load_weights(spark, str(path))) == [(9, 20, 0.5, 0)]


def test_sql_feed_leaves_the_views_of_the_session(frame, spark):
    frame([(1,)], "own int").createOrReplaceTempView("feed")
    feed = frame([("2025-01-14", "05:30", "x"), ("2025-01-14", "06:00", "2")], "DATE_GMT string, TIME_GMT string, EMBEDDED_SOLAR_FORECAST string")
    assert rows(sources.sql_feed(spark, feed, "SELECT * FROM feed"), "solar_generation_kw") == [(None,), (2.0,)]
    assert spark.table("feed").columns == ["own"]
    spark.catalog.dropTempView("feed")
