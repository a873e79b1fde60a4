"""British generation per grid area and the national forecast."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from powerflow.functions.naming import canonical_schema, tag_constants
from powerflow.functions.times import parse_date_time
from powerflow.functions.units import missing_as_null, mw_to_kw
from powerflow.operators.grouping import columns_of, fact_join, newest_poll
from powerflow.operators.matching import exclude_merge_targets, union_feeds
from powerflow.operators.quality import apply_area_flags, settle_areas
from powerflow.operators.reconstruction import MEASURES, reconstruct_weighted
from powerflow.settings import GB_MAX_ID
from powerflow.sources.dimensions import cap_ids, list_active_ids
from powerflow.sources.landed import LANDED
from powerflow.sources.windows import feed_window, time_window

REGIMES = ("in-day", "day-after")
AREA_KEY = ("gsp_id", "datetime_gmt")
POLL_ORDER = ("updated_gmt", LANDED)


def _check_regime(regime: str) -> None:
    if regime not in REGIMES:
        raise ValueError(f"unknown regime {regime!r}, expected one of {REGIMES}")


def with_missing(raw: DataFrame) -> DataFrame:
    return raw.withColumns({name: missing_as_null(F.col(name)) for name in MEASURES})


def delivered(settled: DataFrame, regime: str) -> DataFrame:
    """Settled area rows in kW with the delivered columns."""
    kw = {
        "solar_generation_kw": mw_to_kw(F.col("generation_mw")),
        "capacity_kw": mw_to_kw(F.col("capacity_mwp")),
        "capacity_no_degradation_kw": mw_to_kw(F.col("installedcapacity_mwp")),
    }
    return canonical_schema(
        tag_constants(settled.withColumns(kw), regime=regime), "gb_generation"
    )


def process_gsp(df: DataFrame, regime: str) -> DataFrame:
    """Quality rules, units and delivered columns, for all grid areas at once."""
    _check_regime(regime)
    return delivered(settle_areas(with_missing(df), "gsp_id"), regime)


def wanted_areas(
    registry: DataFrame, weights: DataFrame, targets: DataFrame, max_id: int | None
) -> DataFrame:
    """Ids a run needs, once each: those delivered directly and those that are only sources."""
    live = exclude_merge_targets(list_active_ids(registry, max_id), weights)
    sources = targets.select(F.col("source").alias("gsp_id"))
    both = union_feeds(
        tag_constants(live, is_direct=True), tag_constants(sources, is_direct=False)
    )
    return both.groupBy("gsp_id").agg(F.max("is_direct").alias("is_direct"))


def area_totals(rows: DataFrame, areas: DataFrame) -> DataFrame:
    """Per wanted area: its total capacity and what the quality rules need to know."""
    totals = rows.groupBy("gsp_id").agg(
        F.coalesce(F.sum("capacity_mwp"), F.lit(0.0)).alias("total_capacity"),
        (F.count("generation_mw") == 0).alias("no_generation"),
    )
    return totals.join(areas, "gsp_id").withColumn("no_capacity", F.col("total_capacity") == 0)


def target_totals(totals: DataFrame, targets: DataFrame) -> DataFrame:
    """Per rebuilt area: does the weighted capacity of its sources add up to nothing?"""
    sources = totals.select(F.col("gsp_id").alias("source"), "total_capacity")
    capacity = F.sum(F.col("weight") * F.col("total_capacity"))
    return (
        targets.join(sources, "source")
        .groupBy(F.col("target").alias("gsp_id"))
        .agg((capacity == 0).alias("no_capacity"))
    )


def gb_generation(
    raw: DataFrame,
    registry: DataFrame,
    weights: DataFrame,
    regime: str,
    now: datetime | str,
    max_id: int | None = GB_MAX_ID,
    backfill_hours: float | None = None,
) -> DataFrame:
    """Live areas directly plus retired areas rebuilt from their sources.

    The maximum id applies to both, but not to the sources. A source that is also delivered
    directly enters the sums after its own zero-capacity rule.

    Only the newest poll of an area and time counts. Totals, direct part and weighted sums all start
    from that one shuffle, which Spark runs once.
    """
    _check_regime(regime)
    start, end = feed_window(f"gb_{regime}", now, backfill_hours)
    rows = newest_poll(
        with_missing(time_window(raw, "datetime_gmt", start, end)), AREA_KEY, POLL_ORDER
    )
    targets = cap_ids(weights, max_id, "target")
    wanted = wanted_areas(registry, weights, targets, max_id)
    totals = area_totals(rows, wanted)
    flags = totals.select("gsp_id", "is_direct", "no_capacity", "no_generation")
    flagged = fact_join(rows, flags, "gsp_id", "inner").select(
        *columns_of(rows), "is_direct", "no_capacity", "no_generation"
    )
    direct = apply_area_flags(flagged.filter("is_direct")).drop("is_direct")

    zeroed = F.col("is_direct") & F.col("no_capacity")
    sources = flagged.withColumn(
        "generation_mw", F.when(zeroed, F.lit(0.0)).otherwise(F.col("generation_mw"))
    )
    sums = reconstruct_weighted(sources, targets)
    # sums are never missing, so the rule about missing generation does not apply to them
    rebuilt = apply_area_flags(
        fact_join(
            tag_constants(sums, no_generation=False),
            target_totals(totals, targets),
            "gsp_id",
            "inner",
        )
    )
    return union_feeds(delivered(direct, regime), delivered(rebuilt, regime))


def gb_forecast(raw: DataFrame) -> DataFrame:
    """National forecast from date and time texts and MW values; bad timestamps are dropped."""
    parsed = raw.select(
        parse_date_time(F.col("DATE_GMT"), F.col("TIME_GMT")).alias("target_datetime_utc"),
        mw_to_kw(F.col("EMBEDDED_SOLAR_FORECAST")).alias("solar_generation_kw"),
    )
    return canonical_schema(parsed.filter(F.col("target_datetime_utc").isNotNull()), "forecast")
