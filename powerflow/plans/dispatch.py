"""From a landing folder to the delivered rows of one country.

Layout below the landing folder:

========================================  ====================================================
``gb/generation``                         Parquet, raw grid area rows
``gb/registry``                           Parquet, ``gsp_id`` of the live areas
``gb/forecast/package``                   JSON package descriptions; their paths are relative
                                          to ``gb/forecast``
``nl/<kind>/request_date=D/region_id=R``  JSON responses
``nl/prices``                             Parquet, day-ahead prices
``be/<kind>``                             JSON responses
``de/generation/<region>``                CSV, wide production tables in local time, each with
                                          its own header
``de/capacity``                           Parquet, region, year start and MW
``de/forecast/<type>``                    CSV, wide forecast table in local time
``ind_rajasthan/generation``              JSON responses
========================================  ====================================================

JSON is landed with one response in each line. Windows overlap; of several polls of one key the newest counts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from powerflow.operators.curtailment import PRICE
from powerflow.operators.grouping import anti_join
from powerflow.operators.quality import assert_contract
from powerflow.plans.be import be_forecast, be_generation
from powerflow.plans.de import de_forecast, de_generation
from powerflow.plans.gb import gb_forecast, gb_generation
from powerflow.plans.ind import ind_generation
from powerflow.plans.nl import nl_forecast, nl_generation
from powerflow.schemas import EMPTY_FEED, RAW_GSP
from powerflow.session import config_table
from powerflow.settings import DE_AREAS, GB_MAX_ID, NL_REGION_IDS
from powerflow.sources.dimensions import load_weights
from powerflow.sources.history import table_exists
from powerflow.sources.landed import latest_resource, read_csv_documents, read_documents, read_feed_csv
from powerflow.sources.windows import feed_window

# A response is landed on its request date, or somewhat later where clocks differ
DAY_MARGIN = timedelta(days=1)
KINDS = ("generation", "forecast")
PRICES = f"target_datetime_utc timestamp, {PRICE} double"
DE_CAPACITY = "region string, year_start timestamp, Solar double"


@dataclass(frozen=True)
class FeedRun:
    """One run of a feed: where its files are, the clock and the options of the country.

    Every line of a landed file is one response; without ``lines`` the whole file is. A response that is
    not JSON fails the run; ``on_error="drop"`` leaves it out and counts it in the metrics observed as
    ``landed_documents``. ``modified_after`` is for folders whose files keep their time of landing.
    """

    spark: SparkSession
    landing: str
    now: datetime | str
    regime: str = "in-day"
    backfill_hours: float | None = None
    max_id: int | None = GB_MAX_ID
    weights: object = None
    potential: bool = False
    forecast_type: str = "day_ahead"
    lines: bool = True
    on_error: str = "fail"
    modified_after: datetime | None = None

    def path(self, *parts: str) -> str:
        return "/".join([self.landing.rstrip("/"), *parts])

    def documents(self, *parts: str, since: datetime | None = None) -> DataFrame:
        day = since.date() - DAY_MARGIN if since else None
        found = read_documents(self.spark, self.path(*parts), not self.lines, day, self.modified_after)
        if self.on_error == "fail":
            return found
        if self.on_error != "drop":
            raise ValueError(f"unknown choice on errors {self.on_error!r}, expected fail or drop")
        readable = F.try_parse_json("document").isNotNull()
        seen = found.observe("landed_documents", F.count(F.lit(1)).alias("read"), F.count_if(~readable).alias("dropped"))
        return seen.filter(readable)


def _gb_generation(run: FeedRun) -> DataFrame:
    raw = run.spark.read.schema(RAW_GSP).parquet(run.path("gb", "generation"))
    registry = run.spark.read.schema("gsp_id int").parquet(run.path("gb", "registry"))
    weights = load_weights(run.spark, run.weights)
    return gb_generation(
        raw, registry, weights, run.regime, run.now, run.max_id, run.backfill_hours
    )


def _gb_forecast(run: FeedRun) -> DataFrame:
    packages = latest_resource(
        run.spark.read.text(run.path("gb", "forecast", "package"), wholetext=True).select(
            F.col("value").alias("document"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
    )
    newest = packages.agg(F.max_by("path", "modified")).first()[0]
    if newest is None:
        raise ValueError("no package description names a resource")
    return gb_forecast(read_feed_csv(run.spark, run.path("gb", "forecast", newest)))


def _nl_generation(run: FeedRun) -> DataFrame:
    start, _ = feed_window("nl_generation", run.now)
    raw = run.documents("nl", "generation", since=start)
    if not run.potential:
        return nl_generation(raw, run.now)
    prices = run.path("nl", "prices")
    if table_exists(run.spark, prices):
        return nl_generation(raw, run.now, run.spark.read.schema(PRICES).parquet(prices))
    return nl_generation(raw, run.now, run.spark.createDataFrame([], PRICES))


def missing_requests(run: FeedRun) -> DataFrame:
    """Request dates and regions of the Dutch window that have no landed response.

    The lander asks for a day and region at a time and may give up; a run delivers what there is, and this
    tells what to ask for again. Only the folders of the window are listed, and of them no document is parsed.
    """
    start, end = feed_window("nl_generation", run.now)
    days = (end.date() - start.date()).days + 1
    wanted = [
        {"request_date": start.date() + timedelta(days=day), "region_id": region}
        for day in range(days) for region in NL_REGION_IDS
    ]
    required = config_table(run.spark, wanted, "request_date date, region_id int")
    landed = run.documents("nl", "generation", since=start).select(
        F.col("request_date").cast("date").alias("request_date"), F.col("region_id").cast("int").alias("region_id")
    )
    return anti_join(required, landed, ["request_date", "region_id"])


def _nl_forecast(run: FeedRun) -> DataFrame:
    return nl_forecast(run.documents("nl", "forecast"), run.now)


def _be_generation(run: FeedRun) -> DataFrame:
    start, _ = feed_window("be", run.now, run.backfill_hours)
    raw = run.documents("be", "generation", since=start)
    return be_generation(raw, run.now, run.backfill_hours)


def _be_forecast(run: FeedRun) -> DataFrame:
    return be_forecast(run.documents("be", "forecast"), run.now, run.backfill_hours)


def _wide_csv(run: FeedRun, *parts: str) -> DataFrame:
    return read_csv_documents(run.spark, run.path(*parts))


def _de_generation(run: FeedRun) -> DataFrame:
    areas = {
        region: _wide_csv(run, "de", "generation", region)
        for region in DE_AREAS
        if table_exists(run.spark, run.path("de", "generation", region))
    }
    if not areas:
        empty = f"{EMPTY_FEED}, capacity_kw double, region string, tso_zone string"
        return run.spark.createDataFrame([], empty)
    capacities = run.path("de", "capacity")
    installed = (
        run.spark.read.schema(DE_CAPACITY).parquet(capacities)
        if table_exists(run.spark, capacities)
        else run.spark.createDataFrame([], DE_CAPACITY)
    )
    return de_generation(areas, installed, run.now, run.backfill_hours)


def _de_forecast(run: FeedRun) -> DataFrame:
    kind = run.forecast_type
    return de_forecast(_wide_csv(run, "de", "forecast", kind), kind, run.now)


def _ind_generation(run: FeedRun) -> DataFrame:
    return ind_generation(run.documents("ind_rajasthan", "generation"), run.now)


FEEDS: dict[tuple[str, str], Callable[[FeedRun], DataFrame]] = {
    ("gb", "generation"): _gb_generation,
    ("gb", "forecast"): _gb_forecast,
    ("nl", "generation"): _nl_generation,
    ("nl", "forecast"): _nl_forecast,
    ("be", "generation"): _be_generation,
    ("be", "forecast"): _be_forecast,
    ("de", "generation"): _de_generation,
    ("de", "forecast"): _de_forecast,
    ("ind_rajasthan", "generation"): _ind_generation,
}
COUNTRIES = {country for country, _ in FEEDS}


def feed_dispatch(country: str, kind: str, run: FeedRun) -> DataFrame:
    """Delivered rows of a country's feed, checked for the contract columns.

    An unknown country gives no rows. An error names the country.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}, expected one of {KINDS}")
    if country not in COUNTRIES:
        return run.spark.createDataFrame([], EMPTY_FEED)
    try:
        if (country, kind) not in FEEDS:
            raise ValueError(f"there is no {kind} feed")
        return assert_contract(FEEDS[country, kind](run))
    except Exception as error:
        raise RuntimeError(f"fetching {kind} of {country} failed: {error}") from error
