"""Sinks."""

from powerflow.sinks.tables import (
    append_forecast,
    append_observations,
    append_rows,
    append_site_generation,
    write_csv,
    write_cube,
)

__all__ = ["append_forecast", "append_observations", "append_rows", "append_site_generation", "write_csv", "write_cube"]
