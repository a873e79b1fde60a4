"""Join keys, names, constants and delivered column lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from powerflow.schemas import FEEDS


def stripped(col: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(col, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def normalise_key(col: Column) -> Column:
    return F.lower(stripped(col.cast("string")))


def tag_constants(df: DataFrame, **tags) -> DataFrame:
    """Add one constant column per tag."""
    return df.withColumns(
        {name: v if isinstance(v, Column) else F.lit(v) for name, v in tags.items()}
    )


def lookup_map(col: Column, mapping: Mapping) -> Column:
    """Value of a fixed map; a missing key gives NULL."""
    pairs = chain.from_iterable((F.lit(key), F.lit(value)) for key, value in mapping.items())
    return F.try_element_at(F.create_map(*pairs), col)


def canonical_schema(df: DataFrame, feed: str | Sequence[tuple[str, str]]) -> DataFrame:
    """Rename and narrow to the delivered columns of a feed."""
    columns = FEEDS[feed] if isinstance(feed, str) else feed
    return df.select(*[F.col(source).alias(target) for source, target in columns])


def point_wkt(lon: Column, lat: Column) -> Column:
    return F.concat(
        F.lit("POINT("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")")
    )


def derive_names(kind: str, col: Column) -> Column:
    """Names built from a value: ``asset``, ``observer``, ``forecaster`` or ``de_forecaster``."""
    if kind == "asset":
        return F.concat(F.lit("ruvnl_"), col)
    if kind == "observer":
        return F.concat(F.lit("pvlive_"), F.replace(col, F.lit("-"), F.lit("_")))
    if kind == "forecaster":
        return F.replace(col, F.lit("-"), F.lit("_"))
    if kind == "de_forecaster":
        return F.concat(F.lit("entsoe-de-"), F.replace(col, F.lit("_"), F.lit("-")))
    raise ValueError(f"unknown kind of name: {kind}")
