"""Tagged metadata maps: key -> (number_value, string_value), one of the two set."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from powerflow.schemas import TAGGED_MAP


def number_tag(col: Column) -> Column:
    return F.struct(
        col.cast("double").alias("number_value"),
        F.lit(None).cast("string").alias("string_value"),
    )


def string_tag(col: Column) -> Column:
    return F.struct(
        F.lit(None).cast("double").alias("number_value"),
        col.cast("string").alias("string_value"),
    )


def tagged_map(**tags: Column) -> Column:
    pairs = [part for key, tag in tags.items() for part in (F.lit(key), tag)]
    return F.create_map(*pairs).cast(TAGGED_MAP)


def metadata_value(map_col: Column, key: str, kind: str) -> Column:
    """Typed lookup (``number`` or ``string``); a missing key gives NULL."""
    if kind not in ("number", "string"):
        raise ValueError(f"unknown kind of metadata: {kind}")
    return F.try_element_at(map_col, F.lit(key)).getField(f"{kind}_value")


def merge_metadata(map_col: Column, key: str, value: Column) -> Column:
    """Keep the existing entries and set one numeric entry, truncated to a whole number.

    An existing entry stays a string when its text is not empty and is a number otherwise.
    """

    def one_kind(_, tag: Column) -> Column:
        text = tag.getField("string_value")
        return F.when(text != "", string_tag(text)).otherwise(
            number_tag(tag.getField("number_value"))
        )

    existing = F.coalesce(map_col, F.create_map().cast(TAGGED_MAP))
    others = F.map_filter(existing, lambda name, _: name != F.lit(key))
    added = F.create_map(F.lit(key), number_tag(value.cast("bigint"))).cast(TAGGED_MAP)
    return F.map_concat(F.transform_values(others, one_kind).cast(TAGGED_MAP), added)
