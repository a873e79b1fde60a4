"""Retired grid areas rebuilt from weighted sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from powerflow.operators.grouping import fact_join

MEASURES = ("generation_mw", "installedcapacity_mwp", "capacity_mwp")


def with_first_source(weights: DataFrame) -> DataFrame:
    """Mark the source listed first for each target."""
    first = weights.groupBy("target").agg(F.min("pos").alias("_first"))
    return weights.join(first, "target").withColumn(
        "is_first", F.col("pos") == F.col("_first")
    ).drop("_first")


def join_weights(
    df: DataFrame,
    weights: DataFrame,
    key: str = "gsp_id",
    measures: tuple[str, ...] = MEASURES,
) -> DataFrame:
    """Source rows once per target they contribute to, measures scaled by the weight."""
    sources = weights.withColumnRenamed("source", key)
    scaled = {name: F.col(name) * F.col("weight") for name in measures}
    return fact_join(df, sources, key, "inner").withColumns(scaled)


def reconstruct_weighted(
    df: DataFrame,
    weights: DataFrame,
    key: str = "gsp_id",
    ts: str = "datetime_gmt",
    updated: str = "updated_gmt",
    measures: tuple[str, ...] = MEASURES,
) -> DataFrame:
    """Weighted sum over the sources per target and time, delivered under the target's id.

    Missing values count as zero. The update time is that of the first listed source at the same
    time, or NULL when that source has no such row.
    """
    parts = join_weights(df, with_first_source(weights), key, measures)
    sums = [F.coalesce(F.sum(name), F.lit(0.0)).alias(name) for name in measures]
    first_update = F.max(F.when(F.col("is_first"), F.col(updated))).alias(updated)
    return parts.groupBy("target", ts).agg(*sums, first_update).withColumnRenamed("target", key)
