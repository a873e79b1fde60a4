"""Column-level building blocks."""

from powerflow.functions.metadata import (
    merge_metadata,
    metadata_value,
    number_tag,
    string_tag,
    tagged_map,
)
from powerflow.functions.naming import (
    canonical_schema,
    derive_names,
    lookup_map,
    normalise_key,
    point_wkt,
    tag_constants,
)
from powerflow.functions.times import (
    as_utc,
    drop_past_horizon,
    epoch_to_utc,
    floor_time,
    forecast_horizon,
    local_to_utc,
    minutes_between,
    parse_date_time,
    parse_iso_utc,
    utc_literal,
)
from powerflow.functions.units import (
    capacity_from_percentage,
    cast_float32,
    kw_to_watts,
    missing_as_null,
    mw_to_kw,
    p50_fraction,
)

__all__ = [
    "as_utc",
    "canonical_schema",
    "capacity_from_percentage",
    "cast_float32",
    "derive_names",
    "drop_past_horizon",
    "epoch_to_utc",
    "floor_time",
    "forecast_horizon",
    "kw_to_watts",
    "local_to_utc",
    "lookup_map",
    "merge_metadata",
    "metadata_value",
    "minutes_between",
    "missing_as_null",
    "mw_to_kw",
    "normalise_key",
    "number_tag",
    "p50_fraction",
    "parse_date_time",
    "parse_iso_utc",
    "point_wkt",
    "string_tag",
    "tag_constants",
    "tagged_map",
    "utc_literal",
]
