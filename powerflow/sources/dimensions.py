"""Locations, reconstruction weights and active ids."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from powerflow.schemas import LOCATIONS_CSV, WEIGHTS
from powerflow.session import config_table
from powerflow.settings import GB_MERGE_WEIGHTS, LOCATIONS, SITES

def read_locations(spark: SparkSession, path: str, country: str) -> DataFrame:
    """Location dimension of one country; the filter is pushed into the CSV scan."""
    return (
        spark.read.schema(LOCATIONS_CSV)
        .option("header", True)
        .csv(path)
        .filter(F.col("country_code") == country)
    )


def packaged_locations(spark: SparkSession, country: str) -> DataFrame:
    """The known locations of one country."""
    names = T.StructType.fromDDL(LOCATIONS_CSV).fieldNames()
    rows = [dict(zip(names, row, strict=True)) for row in LOCATIONS]
    return config_table(spark, rows, LOCATIONS_CSV).filter(F.col("country_code") == country)


def site_table(spark: SparkSession, country: str, schema: str) -> DataFrame:
    """Fixed sites of a country of the site store."""
    if country not in SITES:
        raise ValueError(f"no sites for country {country!r}, expected one of {sorted(SITES)}")
    names = ("site_key", "client_site_name", "latitude", "longitude")
    return config_table(spark, [dict(zip(names, row, strict=True)) for row in SITES[country]], schema)


def _parse_config(text: str, path: str) -> dict:
    if path.endswith(".json"):
        return json.loads(text) if text.strip() else {}
    try:
        import yaml
    except ImportError as missing:
        raise ImportError("reading YAML weights needs PyYAML; use JSON instead") from missing
    return yaml.safe_load(text) or {}


def _text_of(spark: SparkSession, path: str) -> str:
    """Text of a configuration file in any store Spark reads; a missing file is empty."""
    try:
        found = spark.read.text(path, wholetext=True).collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return ""
        raise
    return "\n".join(row[0] for row in found)


def load_weights(
    spark: SparkSession, config: Mapping | str | DataFrame | None = None
) -> DataFrame:
    """Reconstruction weights as rows (target, source, weight, pos).

    ``config`` is a mapping target -> sources, a YAML or JSON file of the same form, a DataFrame
    with those columns, or nothing for the packaged weights. The weight defaults to 1, a negative
    one is an error, a missing or empty file has no rows and neither has a target without sources.
    """
    if isinstance(config, DataFrame):
        weight = F.coalesce(F.col("weight"), F.lit(1.0))
        refused = F.raise_error(F.concat(F.lit("negative weight for "), F.col("target")))
        return config.select(
            "target",
            "source",
            F.when(weight < 0, refused).otherwise(weight).alias("weight"),
            "pos",
        )
    if config is None:
        config = GB_MERGE_WEIGHTS
    elif isinstance(config, str):
        path = config
        config = _parse_config(_text_of(spark, path), path)
    rows = []
    for target, entry in config.items():
        sources = (entry or {}).get("pvlive_merge_weights") if isinstance(entry, Mapping) else entry
        for pos, item in enumerate(sources or []):
            if isinstance(item, Mapping):
                source, weight = item["gsp_id"], item.get("weight", 1.0)
            else:
                source, weight = item
            if weight < 0:
                raise ValueError(f"negative weight {weight} for source {source} of {target}")
            rows.append(
                {"target": int(target), "source": int(source), "weight": float(weight), "pos": pos}
            )
    return config_table(spark, rows, WEIGHTS)


def list_active_ids(registry: DataFrame, max_id: int | None, key: str = "gsp_id") -> DataFrame:
    """Ids of the live registry, once each, up to the maximum."""
    return cap_ids(registry, max_id, key).select(key).distinct()


def cap_ids(df: DataFrame, max_id: int | None, key: str = "gsp_id") -> DataFrame:
    """Keep ids up to the maximum; no maximum keeps all."""
    return df if max_id is None else df.filter(F.col(key) <= max_id)
