"""Feeds and jobs composed of the operators."""

from powerflow.plans.app import run_app
from powerflow.plans.backfill import backfill_gsp_cube, backfill_regional_cube
from powerflow.plans.be import be_forecast, be_generation
from powerflow.plans.de import de_forecast, de_generation
from powerflow.plans.dispatch import FeedRun, feed_dispatch, missing_requests
from powerflow.plans.gb import gb_forecast, gb_generation, process_gsp
from powerflow.plans.ind import ind_generation
from powerflow.plans.nl import nl_forecast, nl_generation
from powerflow.plans.platform import no_curtailment_variant, save_forecast, save_generation
from powerflow.plans.sites import site_forecast, site_generation

__all__ = [
    "FeedRun",
    "backfill_gsp_cube",
    "backfill_regional_cube",
    "be_forecast",
    "be_generation",
    "de_forecast",
    "de_generation",
    "feed_dispatch",
    "gb_forecast",
    "gb_generation",
    "ind_generation",
    "missing_requests",
    "nl_forecast",
    "nl_generation",
    "no_curtailment_variant",
    "process_gsp",
    "run_app",
    "save_forecast",
    "save_generation",
    "site_forecast",
    "site_generation",
]
