"""Group and join facts without gathering a group.

A window partitioned by a key sends every row of that key to one task, which fails when one
location holds a large part of the data. The helpers here aggregate first (partial aggregation
leaves one row per key and task) and join the small result back with ``fact_join``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def columns_of(df: DataFrame) -> list[Column]:
    """The columns of a frame in order, for a select after a join that moved its keys."""
    return [F.col(f"`{name}`") for name in df.columns]


def fact_join(
    facts: DataFrame, other: DataFrame, keys: str | Sequence[str], how: str
) -> DataFrame:
    """Join whose fact side the adaptive skew join can split.

    Spark splits a hot partition only when both sides of the join come straight from a shuffle.
    An aggregated side usually does not: the join takes over the shuffle of its aggregate. The
    hash of the keys as a further join key makes the join ask for a shuffle of its own, which for
    an aggregated side is small. A side that Catalyst can broadcast is not shuffled either way.
    """
    keys = as_list(keys)
    alike = [_comparable(facts, other, key) for key in keys]
    # equal values of different types have different hashes, so both sides hash one type
    place = F.xxhash64(*[F.col(f"`{k}`").cast(t) if t else F.col(f"`{k}`") for k, t in zip(keys, alike, strict=True)])
    left, right = (frame.withColumn("_place", place) for frame in (facts, other))
    return left.join(right, ["_place", *keys], how).drop("_place")


def _comparable(facts: DataFrame, other: DataFrame, key: str) -> T.DataType | None:
    """Type in which a key of both sides is hashed; None if the types are the same."""
    types = [frame.schema[key].dataType for frame in (facts, other)]
    if types[0] == types[1]:
        return None
    if all(isinstance(t, T.IntegralType) for t in types):
        return T.LongType()
    if all(isinstance(t, T.NumericType) for t in types):
        return T.DoubleType()
    if all(isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)) for t in types):
        return T.TimestampType()
    raise ValueError(f"key {key!r} is {types[0].simpleString()} on one side and {types[1].simpleString()} on the other")


def anti_join(facts: DataFrame, other: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Facts whose key the other side does not have.

    The other side is reduced to its distinct keys, combined before the shuffle, so copies of one
    key on that side cost one row per task.
    """
    keys = as_list(keys)
    return fact_join(facts, other.select(*keys).distinct(), keys, "left_anti")


def with_group_values(
    df: DataFrame, keys: str | Sequence[str], values: Mapping[str, Column]
) -> DataFrame:
    """Add per-key aggregates to every row of the key; rows with a NULL key are a group as well."""
    keys = as_list(keys)
    place = F.xxhash64(*[F.col(f"`{key}`") for key in keys])
    totals = (
        df.groupBy(*keys).agg(*[col.alias(name) for name, col in values.items()])
        .withColumn("_key_place", place)
        .withColumnsRenamed({key: f"_key_{i}" for i, key in enumerate(keys)})
    )
    same = F.col("_place") == F.col("_key_place")
    for i, key in enumerate(keys):
        same = same & F.col(f"`{key}`").eqNullSafe(F.col(f"_key_{i}"))
    joined = df.withColumn("_place", place).join(totals, same, "left")
    return joined.select(*columns_of(df), *values)


def first_per_key(
    df: DataFrame, keys: str | Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """First row per key in the given order.

    Spark limits each key to one row per task before the shuffle (window group limit), so a hot
    key costs no more than one row per task.
    """
    ranked = Window.partitionBy(*as_list(keys)).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def newest_poll(
    df: DataFrame, keys: str | Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the newest by the ``order`` columns, of which the first counts most.

    Landing windows overlap, so a run reads the same key from several polls. Columns of ``order``
    that the frame lacks are passed over. All other columns, the larger value first, break ties, so
    the choice does not depend on the order of rows. NULL is the oldest and smallest value.
    """
    keys = as_list(keys)
    first = [name for name in order if name in df.columns]
    rest = sorted(
        field.name for field in df.schema.fields
        if field.name not in (*keys, *first) and not isinstance(field.dataType, T.MapType)
    )
    return first_per_key(df, keys, [F.col(f"`{name}`").desc_nulls_last() for name in (*first, *rest)])


def latest_per_location(
    df: DataFrame,
    key: str | Sequence[str] = "location_uuid",
    ts: str = "target_datetime_utc",
    ties: Sequence[Column] = (),
) -> DataFrame:
    """Newest row per location; ``ties`` decide between rows of the same time."""
    return first_per_key(df, key, [F.col(ts).desc(), *ties])


def max_over_key(
    df: DataFrame, key: str | Sequence[str], value: str, name: str = "max_value"
) -> DataFrame:
    return with_group_values(df, key, {name: F.max(value)})


def batch_max(
    df: DataFrame, batch_keys: Sequence[str], col: str, name: str = "batch_max"
) -> DataFrame:
    """Largest value within the batch of each row."""
    return with_group_values(df, batch_keys, {name: F.max(col)})
