"""Totals kept by what changes: rows of a batch as images before and after, and sums that take the difference."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEFORE, AFTER, SIGN, ROWS = "before", "after", "__sign", "__rows"


def change_rows(current: DataFrame, incoming: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """(before, after): the rows that `facts.upsert` of ``incoming`` into ``current`` adds or replaces.

    ``before`` is NULL for a new key. Rows of ``incoming`` that are older than what is there, or equal to it, change nothing.
    Keys are unique on both sides, NULL parts being equal; ``current`` may be cut to the partitions that ``incoming`` touches.
    """
    new = incoming.select(F.struct(*incoming.columns).alias(AFTER))
    old = current.select(F.struct(*incoming.columns).alias(BEFORE))
    same = reduce(lambda a, b: a & b, [F.col(f"{AFTER}.{k}").eqNullSafe(F.col(f"{BEFORE}.{k}")) for k in keys])
    both = new.join(old, same, "left")
    # a struct's missing fields come first, as missing ages are the oldest
    newer = F.struct(*[F.col(f"{AFTER}.{c}") for c in order_by]) >= F.struct(*[F.col(f"{BEFORE}.{c}") for c in order_by])
    return both.filter(F.col(BEFORE).isNull() | (newer & ~F.col(BEFORE).eqNullSafe(F.col(AFTER)))).select(BEFORE, AFTER)


def signed_rows(changes: DataFrame) -> DataFrame:
    """Each row taken away with -1 and each row added with 1, in ``__sign``."""
    image = lambda side, sign: F.struct(F.col(side).alias("row"), F.lit(sign).alias(SIGN))
    rows = changes.select(F.explode(F.array(image(BEFORE, -1), image(AFTER, 1))).alias("image")).filter(F.col("image.row").isNotNull())
    return rows.select("image.row.*", f"image.{SIGN}")


def sums(rows: DataFrame, by: list[str], measures: dict[str, Column], sign: str | None = None) -> DataFrame:
    """Per group the sums of ``measures`` (expressions of a row), how many values each has (``__n_``), and how many rows there are.

    With ``sign``, rows count by the sign in that column. Differences of integers and decimals are exact, of floating-point
    numbers as exact as their sums.
    """
    one = F.lit(1).cast("bigint")
    parts = measures | {f"__n_{n}": F.when(v.isNotNull(), one).otherwise(one - one) for n, v in measures.items()} | {ROWS: one}
    if sign is not None:
        parts = {n: F.when(F.col(sign) < 0, -v).otherwise(v) for n, v in parts.items()}
    return rows.groupBy(*by).agg(*[F.sum(v).alias(n) for n, v in parts.items()])


def with_difference(totals: DataFrame, difference: DataFrame, by: list[str]) -> DataFrame:
    """Both added up, in the types of ``totals``; groups without rows left go."""
    parts = [c for c in totals.columns if c not in by]
    both = totals.unionByName(difference.select(*totals.columns))
    added = both.groupBy(*by).agg(*[F.sum(c).alias(c) for c in parts]).filter(F.col(ROWS) > 0)
    return added.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in totals.schema])


def shown(totals: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    """Groups with their measures; a sum of no values is NULL, as SUM gives."""
    return totals.select(*by, *[F.when(F.col(f"__n_{m}") > 0, F.col(m)).alias(m) for m in measures])
