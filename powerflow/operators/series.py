"""One series out of a wide production table or a mixed list of records."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from powerflow.functions.units import missing_as_null

AGGREGATED = "Actual Aggregated"
SEPARATOR = "|"


def _labels(name: str) -> tuple[str, str | None]:
    """Production and business type of a column; a repeated column ends in ``.1``, ``.2``, ..."""
    plain = re.sub(r"\.\d+$", "", name)
    production, separator, business = plain.partition(SEPARATOR)
    return production, business if separator else None


def pick_series(
    df: DataFrame,
    keep: Sequence[str],
    production: str = "Solar",
    business: str = AGGREGATED,
    value: str = "value",
) -> DataFrame:
    """One production type of a wide table, as ``keep`` columns and a value.

    Columns are named ``Solar`` or ``Solar|Actual Aggregated``. Aggregated columns are preferred
    when the table has any; of several matching columns the first is used; without one there are no
    rows. The choice depends on the header only, so the scan reads a single measure column.
    """
    columns = [name for name in df.columns if name not in keep]
    preferred = [name for name in columns if _labels(name)[1] == business]
    matches = [name for name in preferred or columns if _labels(name)[0] == production]
    if not matches:
        nothing = F.lit(None).cast("double").alias(value)
        return df.select(*keep, nothing).filter(F.lit(False))
    picked = missing_as_null(F.col(f"`{matches[0]}`").cast("double"))
    return df.select(*keep, picked.alias(value)).filter(F.col(value).isNotNull())


def pick_landed_series(
    df: DataFrame,
    keep: Sequence[str],
    others: Sequence[str] = (),
    production: str = "Solar",
    business: str = AGGREGATED,
    value: str = "value",
) -> DataFrame:
    """The series of ``pick_series`` out of lines that each bring the header of their own file.

    ``df`` has the arrays ``header`` and ``cells``; ``keep`` are names in the header, ``others`` columns of
    the frame. The column is chosen in each row, so files may differ and nothing is shuffled.
    """
    plain = F.transform("header", lambda name: F.regexp_replace(name, r"\.\d+$", ""))
    open_ = F.transform(plain, lambda name: F.when(~name.isin(*keep), name))
    aggregated = F.exists(open_, lambda name: F.endswith(name, F.lit(f"{SEPARATOR}{business}")))

    def place(name: str) -> Column:
        return F.array_position(F.col("header"), name)

    exact = F.array_position(open_, f"{production}{SEPARATOR}{business}")
    loose = F.transform(open_, lambda name: F.split_part(name, F.lit(SEPARATOR), F.lit(1)))
    chosen = F.when(F.coalesce(aggregated, F.lit(False)), exact).otherwise(F.array_position(loose, production))
    number = F.get("cells", (chosen - 1).cast("int")).try_cast("double")
    picked = F.when(chosen > 0, missing_as_null(number))
    kept = [F.get("cells", (place(name) - 1).cast("int")).alias(name) for name in keep]
    return df.select(*kept, *others, picked.alias(value)).filter(F.col(value).isNotNull())


def first_per_asset(
    df: DataFrame,
    records: str,
    names: Mapping[str, str],
    name_field: str = "scada_name",
    label: str = "energy_type",
) -> DataFrame:
    """First record of each named asset in the order of the ``records`` array.

    Works inside each row, so nothing is shuffled. Adds the record as ``asset`` and its label.
    """

    def first_named(name: str):
        named = F.filter(F.col(records), lambda record: record.getField(name_field) == name)
        return F.get(named, F.lit(0))

    assets = [
        F.struct(F.lit(text).alias(label), first_named(name).alias("asset"))
        for name, text in names.items()
    ]
    others = [name for name in df.columns if name != records]
    return df.select(*others, F.inline(F.array(*assets))).filter(F.col("asset").isNotNull())
