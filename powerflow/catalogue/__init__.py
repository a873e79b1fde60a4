"""Registered queries over the driver tables."""

from powerflow.catalogue import columns, feeds, joins, rules, scans, stores, streams, totals
from powerflow.catalogue.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "columns",
    "feeds",
    "joins",
    "rules",
    "scans",
    "stores",
    "streams",
    "totals",
]
