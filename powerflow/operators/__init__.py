"""DataFrame operators."""

from powerflow.operators.capacity import (
    capacity_override,
    capacity_updates,
    complete_timestamps,
    latest_capacity,
    max_generation_default,
    national_vs_regional,
    region_set_complete,
    regional_sum,
    seed_capacity,
    validate_capacity,
)
from powerflow.operators.cubes import cube_columns, pivot_cube
from powerflow.operators.curtailment import potential_generation
from powerflow.operators.grouping import (
    batch_max,
    first_per_key,
    latest_per_location,
    newest_poll,
    max_over_key,
    with_group_values,
)
from powerflow.operators.matching import (
    country_isolation,
    drop_existing,
    exclude_merge_targets,
    has_metadata_key,
    join_locations,
    join_name_map,
    join_prices,
    missing_members,
    order_output,
    registry_equality,
    route_by_key,
    set_difference,
    union_feeds,
    unmatched_keys,
)
from powerflow.operators.quality import (
    assert_contract,
    daily_grid,
    drop_incomplete,
    drop_negative_power,
    drop_null_unless_all_null,
    drop_over_capacity,
    drop_zero_capacity,
    duplicate_timestamps,
    flag_small_percentage,
    flag_stale,
    grid_completeness,
    partition_flags,
    reject_null_prices,
    settle_areas,
    trim_unsettled,
    zero_gen_when_no_capacity,
)
from powerflow.operators.reconstruction import join_weights, reconstruct_weighted
from powerflow.operators.registry import (
    capacity_history,
    current_locations,
    get_or_create_site,
    missing_sites,
    seed_locations,
    update_site_capacity,
    upsert_forecaster,
)
from powerflow.operators.series import first_per_asset, pick_series
from powerflow.operators.totals import (
    collect_observations,
    distinct_keys,
    run_summary,
    time_extent,
)

__all__ = [
    "assert_contract",
    "batch_max",
    "capacity_history",
    "capacity_override",
    "capacity_updates",
    "collect_observations",
    "complete_timestamps",
    "country_isolation",
    "cube_columns",
    "current_locations",
    "daily_grid",
    "distinct_keys",
    "drop_existing",
    "drop_incomplete",
    "drop_negative_power",
    "drop_null_unless_all_null",
    "drop_over_capacity",
    "drop_zero_capacity",
    "duplicate_timestamps",
    "exclude_merge_targets",
    "first_per_asset",
    "first_per_key",
    "flag_small_percentage",
    "flag_stale",
    "get_or_create_site",
    "grid_completeness",
    "has_metadata_key",
    "join_locations",
    "join_name_map",
    "join_prices",
    "join_weights",
    "latest_capacity",
    "latest_per_location",
    "newest_poll",
    "max_generation_default",
    "max_over_key",
    "missing_members",
    "missing_sites",
    "national_vs_regional",
    "order_output",
    "partition_flags",
    "pick_series",
    "pivot_cube",
    "potential_generation",
    "reconstruct_weighted",
    "region_set_complete",
    "regional_sum",
    "registry_equality",
    "reject_null_prices",
    "route_by_key",
    "run_summary",
    "seed_capacity",
    "seed_locations",
    "set_difference",
    "settle_areas",
    "time_extent",
    "trim_unsettled",
    "union_feeds",
    "unmatched_keys",
    "update_site_capacity",
    "upsert_forecaster",
    "validate_capacity",
    "with_group_values",
    "zero_gen_when_no_capacity",
]
