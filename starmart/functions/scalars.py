"""Small scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def entity_key(value: Column) -> Column:
    """One spelling per entity: trimmed upper case, empty text is no key."""
    return F.nullif(F.upper(F.trim(value)), F.lit(""))


def seconds_between(start: str, end: str) -> Column:
    """Seconds from ``start`` to ``end`` (microsecond precision); NULL if either is missing."""
    return (F.col(end) - F.col(start)).cast("interval second").cast("decimal(18,6)").cast("double")


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Add each absent column as a constant. A column that exists keeps its nulls.

    A default is a plain value, a typed Column, or a DDL type name behind ``None`` as ``(None, "double")``.
    """
    present = set(df.columns)
    added = {}
    for name, default in defaults.items():
        if name in present:
            continue
        if isinstance(default, tuple):
            value, type_name = default
            added[name] = F.lit(value).cast(type_name)
        else:
            added[name] = default if isinstance(default, Column) else F.lit(default)
    return df.withColumns(added) if added else df
