"""Table conformance, latest-per-key selection and upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(
    df: DataFrame,
    target: T.StructType,
    now: Column | None = None,
    false_by_default: list[str] | None = None,
    now_by_default: list[str] | None = None,
) -> DataFrame:
    """Select, order and cast to the target's columns and types.

    A value that does not fit its type becomes NULL (the rules ``type:`` of `quality.row_rules` find it); an absent
    column becomes NULL; then the named defaults fill what is NULL.
    """
    now = F.current_timestamp() if now is None else now
    columns = []
    for field in target:
        if field.name in df.columns:
            value = F.col(field.name).try_cast(field.dataType)
        else:
            value = F.lit(None).cast(field.dataType)
        if field.name in (false_by_default or []):
            value = F.coalesce(value, F.lit(False))
        if field.name in (now_by_default or []):
            value = F.coalesce(value, now.cast(field.dataType))
        columns.append(value.alias(field.name))
    return df.select(*columns)


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the one with the largest ``order_by`` values (missing values count as oldest).

    The filter on the row number turns into a group limit before the shuffle, so each task
    sends at most one row per key, however many copies a key has. ``order_by`` should tell
    any two rows of a key apart; a content hash of the row settles what is left.
    """
    tie_break = F.xxhash64(*[F.col(c) for c in df.columns])
    order = [F.col(c).desc_nulls_last() for c in order_by] + [tie_break.desc()]
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__newest", newest).filter("__newest = 1").drop("__newest")


def upsert(existing: DataFrame | None, incoming: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The rows of both sides, newest per key. At equal age the incoming row wins."""
    if existing is None:
        return latest_per_key(incoming, keys, order_by)
    both = existing.withColumn("__arrived", F.lit(0)).unionByName(incoming.withColumn("__arrived", F.lit(1)))
    return latest_per_key(both, keys, [*order_by, "__arrived"]).drop("__arrived")
