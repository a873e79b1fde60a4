from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from powerflow import catalogue

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "orders", "events")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not there")

# one query per kind; check.py compares all of them
SAMPLE = [
    "flatten_records", "parse_date_time", "settle_areas", "reconstruct_weighted", "drop_existing",
    "validate_capacity", "capacity_updates", "gb_generation", "nl_generation", "save_generation",
    "site_registry", "backfill_gsp_cube", "stream_ingest",
]


@pytest.fixture(autouse=True)
def compiled(spark):
    """These run as they do outside the tests, with compiled plans."""
    names = ("spark.sql.codegen.wholeStage", "spark.sql.codegen.factoryMode")
    before = [spark.conf.get(name) for name in names]
    for name, value in zip(names, ("true", "FALLBACK"), strict=True):
        spark.conf.set(name, value)
    yield
    for name, value in zip(names, before, strict=True):
        spark.conf.set(name, value)


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)
    assert len(catalogue.QUERIES) > 100
    assert set(catalogue.QUERIES) <= set(entry.queries()) >= set(entry.oracle_sql())


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    mine = sorted(map(repr, (tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())))
    quoted = ", ".join(f'"{c}"' for c in columns)
    sql = f"SELECT {quoted} FROM ({entry.oracle_sql()[name]})"
    assert mine == sorted(map(repr, connection.sql(sql).fetchall()))
