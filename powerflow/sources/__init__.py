"""Scans: landed feeds, dimensions, history and time windows."""

from powerflow.sources.dimensions import (
    cap_ids,
    list_active_ids,
    load_weights,
    packaged_locations,
    read_locations,
    site_table,
)
from powerflow.sources.history import (
    days_of,
    on_days,
    read_existing_observations,
    read_table,
    since_batch,
    table_exists,
)
from powerflow.sources.landed import (
    flatten_records,
    latest_resource,
    newest_path,
    read_documents,
    read_feed_csv,
    records_array,
    sql_feed,
)
from powerflow.sources.windows import feed_window, time_chunks, time_window

__all__ = [
    "cap_ids",
    "days_of",
    "feed_window",
    "flatten_records",
    "latest_resource",
    "list_active_ids",
    "load_weights",
    "newest_path",
    "on_days",
    "packaged_locations",
    "read_documents",
    "read_existing_observations",
    "read_feed_csv",
    "read_locations",
    "read_table",
    "records_array",
    "since_batch",
    "site_table",
    "sql_feed",
    "table_exists",
    "time_chunks",
    "time_window",
]
