from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from powerflow import schemas
from powerflow.settings import PROFILES
from powerflow.sinks import append_rows
from powerflow.streaming import run_available, stream_enrich_guard, stream_ingest, stream_settled
from tests.conftest import at, rows
from tests.test_stores import FACTS, gb_registry

T0, T1 = at("2025-01-14 12:00"), at("2025-01-14 12:30")


def land(frame, path, data, schema):
    frame(data, schema).coalesce(1).write.mode("append").parquet(path)


def test_overlapping_polls_are_stored_once(spark, frame, tmp_path):
    landing, store, checkpoint = (str(tmp_path / name) for name in ("landing", "store", "cp"))
    row = ("SOLAR", "o")
    first = [("A", *row, T0, 5), ("A", *row, T0, 5), ("B", *row, T0, 7)]
    second = [("A", *row, T0, 6), ("A", *row, T1, 8), ("B", *row, at("2024-12-01 00:00"), 1)]
    for poll in (first, second):
        land(frame, landing, poll, schemas.OBSERVATIONS)
        stream = spark.readStream.schema(schemas.OBSERVATIONS).parquet(landing)
        stream_ingest(stream, store, checkpoint).awaitTermination()
    stored = spark.read.parquet(store)
    assert rows(stored, "location_uuid", "timestamp_utc", "value_watts") == [
        ("A", T0, 5), ("A", T1, 8), ("B", at("2024-12-01 00:00"), 1), ("B", T0, 7)
    ]
    again = spark.readStream.schema(schemas.OBSERVATIONS).parquet(landing)
    stream_ingest(again, store, str(tmp_path / "fresh")).awaitTermination()
    assert spark.read.parquet(store).count() == 4


def test_stream_uses_the_batch_rules(spark, frame, tmp_path):
    landing = str(tmp_path / "landing")
    data = [(1, "in-day", 2000.0, 1.0, 100.0, T0), (1, "in-day", 2000.0, 1.0, 3000.0, T1), (9, "in-day", 1.0, 1.0, 1.0, T0)]
    land(frame, landing, data, FACTS)
    stream = spark.readStream.schema(FACTS).parquet(landing)
    guarded = stream_enrich_guard(stream, gb_registry(frame, [1]), PROFILES["gb"])
    store = str(tmp_path / "store")
    run_available(guarded, lambda batch, _: append_rows(batch, store), str(tmp_path / "cp")).awaitTermination()
    assert rows(spark.read.parquet(store), "location_uuid", "value_watts") == [("uuid-1", 100_000)]


def test_unsettled_rows_wait_for_a_later_poll(spark, frame, tmp_path):
    landed = "region int, validto timestamp, lastupdate timestamp, response_update timestamp"
    kept = "region int, validto timestamp, lastupdate timestamp"
    landing = str(tmp_path / "landing")
    first, second = at("2025-01-14 12:40"), at("2025-01-14 13:00")
    land(frame, landing, [(1, T0, first, first), (1, T1, first, first)], landed)
    land(frame, landing, [(1, T0, second, second), (1, T1, second, second)], landed)
    for files in (1, 9):
        store = str(tmp_path / f"store-{files}")
        for attempt in range(2):  # the second run gets the same files again
            stream = spark.readStream.schema(landed).option("maxFilesPerTrigger", files).parquet(landing)
            stream_settled(stream, store, str(tmp_path / f"cp-{files}-{attempt}"), ["region", "validto"], kept).awaitTermination()
        assert rows(spark.read.parquet(store), "region", "validto") == [(1, T0), (1, T1)]


def spoil(folder):
    """Make every Parquet file below a folder unreadable."""
    for file in folder.rglob("*.parquet"):
        file.write_bytes(b"spoilt")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)


def test_micro_batches_read_their_own_days(spark, frame, tmp_path):
    """Stored days that no landed row falls on are never opened, also when a row is late."""
    landed = "region int, validto timestamp, lastupdate timestamp, response_update timestamp"
    kept = "region int, validto timestamp, lastupdate timestamp"
    landing, store, cp = str(tmp_path / "landing"), tmp_path / "store", str(tmp_path / "cp")
    late = at("2025-03-01 00:00")

    def poll(times):
        land(frame, landing, [(1, t, late, late) for t in times], landed)
        stream = spark.readStream.schema(landed).parquet(landing)
        stream_settled(stream, str(store), cp, ["region", "validto"], kept).awaitTermination()

    days = [at(f"2025-01-{day:02} 10:00") for day in (5, 6, 7, 8)]
    poll(days)
    for day in (5, 7, 8):
        spoil(store / f"date=2025-01-{day:02}")
    poll([days[1], at("2025-01-06 11:00"), at("2024-12-30 09:00")])  # a stored one, a new one and a late one
    assert rows(spark.read.parquet(str(store / "date=2025-01-06")), "validto") == [(days[1],), (at("2025-01-06 11:00"),)]
    assert len(list((store / "date=2024-12-30").glob("*.parquet"))) == 1
    with pytest.raises(Exception, match="(?i)parquet"):
        poll([days[0]])


def test_observations_are_ingested_by_their_own_days(spark, frame, tmp_path):
    landing, store, cp = str(tmp_path / "landing"), tmp_path / "store", str(tmp_path / "cp")
    times = [at(f"2025-01-{day:02} 10:00") for day in (5, 6, 7)]

    def poll(times):
        land(frame, landing, [("A", "SOLAR", "o", t, 1) for t in times], schemas.OBSERVATIONS)
        stream_ingest(spark.readStream.schema(schemas.OBSERVATIONS).parquet(landing), str(store), cp).awaitTermination()

    poll(times)
    spoil(store / "observer_name=o" / "date=2025-01-06")
    spoil(store / "observer_name=o" / "date=2025-01-07")
    poll([times[0], at("2025-01-05 12:00")])
    assert spark.read.parquet(str(store / "observer_name=o" / "date=2025-01-05")).count() == 2


def test_settled_keys_for_any_file_order_and_after_a_restart(spark, frame, tmp_path):
    landed = "region int, validto timestamp, lastupdate timestamp, response_update timestamp"
    kept = "region int, validto timestamp, lastupdate timestamp"
    first, second, third = (at(f"2025-01-14 {t}") for t in ("12:40", "13:00", "13:30"))
    polls = [[(r, t, seen, seen) for r in (1, 2) for t in (T0, T1)] for seen in (first, second, third)]
    found = []
    for number, order in enumerate([(0, 1, 2), (2, 0, 1), (1, 2, 0)]):
        landing, store, cp = (str(tmp_path / f"{name}-{number}") for name in ("landing", "store", "cp"))
        for place in order:  # each poll is a run that goes on where the checkpoint ended
            land(frame, landing, polls[place], landed)
            stream = spark.readStream.schema(landed).option("maxFilesPerTrigger", 1).parquet(landing)
            stream_settled(stream, store, cp, ["region", "validto"], kept).awaitTermination()
        found.append(rows(spark.read.parquet(store), "region", "validto"))
    assert found == [[(r, t) for r in (1, 2) for t in (T0, T1)]] * 3


def test_hot_keys_are_split(spark):
    """One location holds a third of all rows and nothing is small enough to be broadcast."""
    from powerflow import operators as op

    overrides = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {name: spark.conf.get(name, None) for name in overrides}
    for name, value in overrides.items():
        spark.conf.set(name, value)
    try:
        n = 300_000
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5003)
        facts = spark.range(n, numPartitions=8).select(
            "id",
            hot.cast("bigint").alias("k"),
            F.when(hot == 7, 0).otherwise(F.col("id")).alias("t"),
            F.rand(1).alias("generation_mw"),
            F.lit(1.0).alias("capacity_mwp"),
        )
        results = {
            "flags": op.settle_areas(facts, "k"),
            "anti": op.drop_existing(facts, facts.filter("k > 2500"), ["k", "t"]),
        }
        for name, df in results.items():
            execution = df._jdf.queryExecution()
            execution.toRdd().count()
            final = execution.executedPlan().toString().split("Initial Plan")[0]
            assert "skew=true" in final, name
        newest = op.latest_per_location(facts, "k", "id")
        plan = newest._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Partial") > plan.index("Exchange")
        assert newest.count() == 5003
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
