"""Generation corrected for curtailment at low day-ahead prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from powerflow.operators.matching import join_prices
from powerflow.operators.quality import reject_null_prices

PRICE = "NL_day_ahead_prices_euros_per_mwh"
POTENTIAL = "solar_generation_no_curtailment_kw"


def potential_generation(
    df: DataFrame,
    prices: DataFrame,
    threshold: float = 0.0,
    mult: float = 1.11,
    ts: str = "target_datetime_utc",
    price: str = PRICE,
    generation: str = "solar_generation_kw",
) -> DataFrame:
    """Add the generation without curtailment.

    Where the price is at or below the threshold the generation is scaled up; with an unknown
    price, or a price set that has gaps and is refused as a whole, it is unchanged.
    """
    priced = join_prices(df, reject_null_prices(prices, price), ts)
    curtailed = F.col(price) <= F.lit(threshold)
    value = F.when(curtailed, F.col(generation) * F.lit(mult)).otherwise(F.col(generation))
    return priced.withColumn(POTENTIAL, value)
