"""Cutting groups in sort order into ranges, so that no task has to hold a whole group.

A window over (season) or (driver) puts a whole season or driver into one task. The operators in `windows` instead give
each row the number of the range of (group, order) it falls into, work range by range, and carry a small summary from one
range to the next where a group spans both. The number of ranges changes only the balance, never the result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGES = "starmart.windowRanges"
RANGE = "__range"
#: sampled values a range: its size then is about 1/n of the distinct values, give or take a quarter
SAMPLES = 20
_HASHES = 1 << 40


def ascending(columns: list[str]) -> list[Column]:
    """Values that sort by ``columns`` ascending with nulls last, where a comparison puts nulls first."""
    return [part for c in columns for part in (F.col(c).isNull(), F.col(c))]


def _range_count(df: DataFrame) -> int:
    conf = df.sparkSession.conf
    return int(conf.get(RANGES, None) or conf.get("spark.sql.shuffle.partitions"))


def _bounds(df: DataFrame, place: Column, n: int) -> DataFrame:
    """One row: n - 1 values of ``place`` in order, that cut its distinct values into about equal ranges.

    A sketch of the number of distinct values sets the share to sample, and a hash of the value picks the sample, so a
    value held by very many rows counts once and the same rows always give the same bounds. Some 20 n values are sampled
    however many rows there are, on the map side, and values keep their type.
    """
    hashed = df.select(place.alias("place")).withColumn("hash", F.xxhash64("place"))
    # not a filter: it would be planned a second time, as a filter of the scan
    share = F.least(F.lit(1.0), F.lit(SAMPLES * n) / F.greatest(F.approx_count_distinct("hash"), F.lit(1)))
    limit = hashed.select((share * F.lit(_HASHES)).cast("bigint")).scalar()
    picked = hashed.withColumn("limit", limit).select(F.when(F.pmod("hash", F.lit(_HASHES)) < F.col("limit"), F.col("place")))
    sample = picked.toDF("place").select(F.sort_array(F.collect_set("place")).alias("s"))
    cuts = F.transform(
        F.sequence(F.lit(1), F.lit(n - 1)), lambda i: F.get("s", F.floor(i * F.size("s") / F.lit(n)).cast("int"))
    )
    return sample.select(cuts.alias("cuts"))


def numbered(df: DataFrame, place: Column, n: int, out: str) -> DataFrame:
    """``df`` with ``out``, the number (0 to n - 1) of the range that ``place`` falls into; it never decreases with it."""
    if n < 2:
        return df.withColumn(out, F.lit(0))
    steps = F.lit([1 << i for i in reversed(range(math.ceil(math.log2(n))))])
    # binary search: how many bounds are at or before the row; the one-element array holds the row's place meanwhile
    passed = F.transform(
        F.array(place),
        lambda here: F.aggregate(
            steps,
            F.lit(0),
            lambda at, step: F.when(F.get("__cuts", at + step - 1) <= here, at + step).otherwise(at),
        ),
    )
    cut = df.withColumn("__cuts", _bounds(df, place, n).scalar())
    return cut.withColumn(out, F.get(passed, F.lit(0))).drop("__cuts")


def in_ranges(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``df`` with ``__range``, a number that never decreases along (keys, order ascending, nulls first).

    It is an expression over the row's own values and the bounds, a scalar subquery: equal rows share a range, nothing is
    shuffled or written, and every reader of the frame sees the same ranges. `starmart.windowRanges` sets how many there
    are (as many as shuffle partitions if unset).
    """
    keyed = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    place = F.struct(*keyed, *[o.alias(f"o{i}") for i, o in enumerate(order)])
    return numbered(df, place, _range_count(df), RANGE)


def earlier_total(df: DataFrame, keys: list[str], weight: Column, out: str, backwards: bool = False) -> DataFrame:
    """(keys, __range, out): what the key's earlier ranges (later ones if ``backwards``) weigh together, where it has any.

    A range begins inside one key at most, so there is at most one row a range.
    """
    along = F.col(RANGE).desc() if backwards else F.col(RANGE)
    before = Window.partitionBy(*keys).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, RANGE).agg(F.sum(weight).alias("__weight"))
    return totals.select(*keys, RANGE, F.sum("__weight").over(before).alias(out)).filter(F.col(out).isNotNull())
