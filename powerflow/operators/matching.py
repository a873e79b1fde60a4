"""Joins of facts with dimensions, history and each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from powerflow.functions.metadata import metadata_value
from powerflow.functions.naming import normalise_key
from powerflow.operators.grouping import anti_join, as_list, columns_of, fact_join, newest_poll
from powerflow.operators.quality import drop_zero_capacity
from powerflow.settings import CountryProfile


def country_isolation(loc: DataFrame, country: str, home: str = "gb") -> DataFrame:
    """Locations of one country; those without a country belong to the home country."""
    stored = metadata_value(F.col("metadata"), "country", "string")
    if country == home:
        return loc.filter(F.coalesce(F.nullif(stored, F.lit("")), F.lit(home)) == home)
    return loc.filter(stored == country)


def has_metadata_key(loc: DataFrame, key: str) -> DataFrame:
    return loc.filter(F.coalesce(F.map_contains_key("metadata", key), F.lit(False)))


def registry_key(loc: DataFrame, profile: CountryProfile) -> DataFrame:
    """Add ``join_key``, the value by which the country's facts name a location.

    Text keys of countries that normalise fall back to the location name; in the other countries
    a location without the key in its metadata cannot be joined.
    """
    value = metadata_value(F.col("metadata"), profile.id_key, profile.metadata_kind)
    if profile.normalise:
        return loc.withColumn(
            "join_key", normalise_key(F.coalesce(value, F.col("location_name")))
        )
    return has_metadata_key(loc, profile.id_key).withColumn("join_key", value)


def fact_key(df: DataFrame, profile: CountryProfile) -> DataFrame:
    """Add the facts' side of ``join_key``."""
    kind = "double" if profile.metadata_kind == "number" else "string"
    return df.withColumn("join_key", F.col(profile.id_key).cast(kind))


def join_locations(df: DataFrame, loc: DataFrame, profile: CountryProfile) -> DataFrame:
    """Facts with their location; zero capacity and unknown keys drop out.

    Adds ``new_effective_capacity_watts``. A location column that the facts also have is renamed
    with ``_loc``.
    """
    facts = fact_key(drop_zero_capacity(df), profile)
    keyed = registry_key(loc, profile)
    clashes = {name: f"{name}_loc" for name in keyed.columns if name in df.columns}
    joined = fact_join(facts, keyed.withColumnsRenamed(clashes), "join_key", "inner")
    return joined.withColumn("new_effective_capacity_watts", F.col("capacity_kw") * F.lit(1000))


def unmatched_keys(df: DataFrame, loc: DataFrame, profile: CountryProfile) -> DataFrame:
    """Keys of the facts that no location has."""
    keys = fact_key(df, profile).select(profile.id_key, "join_key").distinct()
    return anti_join(keys, registry_key(loc, profile), "join_key").select(profile.id_key)


def missing_members(required: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Required dimension members that are not there yet."""
    return anti_join(required, present, key)


def set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``a`` that ``b`` does not have."""
    return anti_join(a.select(key).distinct(), b, key)


def registry_equality(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows on which two lists differ, as multisets: ``surplus`` > 0 is in ``a`` only.

    One aggregate over both lists; no rows means they are equal.
    """
    cols = a.columns
    both = a.withColumn("_n", F.lit(1)).unionByName(b.select(*cols).withColumn("_n", F.lit(-1)))
    return both.groupBy(*cols).agg(F.sum("_n").alias("surplus")).filter("surplus <> 0")


def join_prices(
    df: DataFrame, prices: DataFrame, ts: str = "target_datetime_utc"
) -> DataFrame:
    """Generation with the price of the same timestamp, if there is one; of several polls the newest."""
    newest = newest_poll(prices, ts, ["landed"]).drop("landed")
    others = [name for name in newest.columns if name != ts]
    return fact_join(df, newest, ts, "left").select(*columns_of(df), *others)


def drop_existing(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Facts whose whole key is not stored yet.

    All key columns are compared together, so a time stored for one location does not suppress
    another location.
    """
    return anti_join(df, existing, keys)


def join_name_map(df: DataFrame, names: DataFrame, left: str, right: str) -> DataFrame:
    """Inner join on differently named keys, keeping the right one."""
    return df.join(names, df[left] == names[right], "inner").drop(left)


def exclude_merge_targets(ids: DataFrame, weights: DataFrame, key: str = "gsp_id") -> DataFrame:
    """Ids that are taken directly: a rebuilt area is left out even if it is still listed."""
    return anti_join(ids, weights.select(F.col("target").alias(key)), key)


def route_by_key(df: DataFrame, sites: DataFrame, key: str) -> DataFrame:
    """Rows of the known sites, each with its site's columns, in one pass."""
    keyed = df.withColumn("site_key", F.col(key).cast("string"))
    return fact_join(keyed, sites, "site_key", "inner").drop("site_key")


def union_feeds(*frames: DataFrame) -> DataFrame:
    """All rows of all frames by column name; a missing column is NULL."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def order_output(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Sort for delivery. Only sinks need it; nothing upstream relies on order.

    The other columns break ties, which makes the order reproducible and lets the range
    partitioning split a timestamp that many rows share.
    """
    cols = as_list(cols)
    sortable = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return df.orderBy(*cols, *[F.col(f"`{n}`") for n in sortable if n not in cols])
