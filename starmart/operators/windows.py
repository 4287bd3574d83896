"""Ranks, positions and neighbours within groups, without a task per group.

One plan for all sizes: rows (or, for ranks, distinct scores) are cut into ranges of their sort order (see `ranges`), a
window works within each range, and at most one row per range carries on what a group has before it. Rows are shuffled
once, to (group, range). Values are compared in their own types. Inputs are read several times, for the keys and order
columns only but for one, and have to give the same values each time: pass a scan, or a staged frame when they are costly
or hold sums of floating-point numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.ranges import RANGE, ascending, earlier_total, in_ranges


def _match(left: DataFrame, right: DataFrame, columns: list[str], how: str = "left") -> DataFrame:
    """Join on columns in which NULL matches NULL, keeping the left copy of them."""
    right = right.withColumnsRenamed({c: f"__r_{c}" for c in columns})
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return left.join(right, condition, how).drop(*[f"__r_{c}" for c in columns])


def rank_within(df: DataFrame, by: list[str], score: str, out: str = "championship_rank") -> DataFrame:
    """RANK() of each row within ``by``, best (largest) score first; ties share a rank, missing scores come last.

    It ranks the distinct scores: rank = 1 + number of rows with a better score. Rows that share a score are counted on
    the map side and get their rank by an equi-join, which adaptive execution splits if one score is very common.
    """
    best_first = F.col(score).desc_nulls_last()
    placed = in_ranges(df.select(*by, score), by, [F.col(score)])
    scores = placed.groupBy(*by, RANGE, score).agg(F.count(F.lit(1)).alias("__rows"))
    better = Window.partitionBy(*by, RANGE).orderBy(best_first).rowsBetween(Window.unboundedPreceding, -1)
    ranks = scores.withColumn("__local", F.coalesce(F.sum("__rows").over(better), F.lit(0)))
    # ranges go up, ranks go down: what is better lies in later ranges
    offsets = earlier_total(placed, by, F.lit(1), "__offset", backwards=True)
    ranks = _match(ranks, F.broadcast(offsets), [*by, RANGE])
    ranks = ranks.select(*by, score, (F.coalesce("__offset", F.lit(0)) + F.col("__local") + 1).cast("int").alias(out))
    return _match(df, ranks, [*by, score])


def top_ranked(df: DataFrame, by: list[str], score: str, k: int, out: str = "championship_rank") -> DataFrame:
    """Rows whose rank within ``by`` is at most ``k``, ties included.

    At most k distinct scores per group can qualify. Finding them is a group limit on the distinct scores (applied before
    the shuffle), so a score shared by most rows costs nothing. Spark plans such a limit up to its own setting; a longer
    list is cut from the full ranking.
    """
    if k > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        return rank_within(df, by, score, out).filter(F.col(out) <= k)
    best_first = Window.partitionBy(*by).orderBy(F.col(score).desc_nulls_last())
    better = best_first.rowsBetween(Window.unboundedPreceding, -1)
    scores = df.groupBy(*by, score).agg(F.count(F.lit(1)).alias("__rows"))
    scores = scores.withColumn("__nth", F.row_number().over(best_first)).filter(F.col("__nth") <= k)
    ranks = scores.withColumn(out, (F.coalesce(F.sum("__rows").over(better), F.lit(0)) + 1).cast("int"))
    ranks = ranks.filter(F.col(out) <= k).drop("__rows", "__nth")
    return _match(df, ranks, [*by, score], "inner")


def position_within(df: DataFrame, keys: list[str], order_by: list[str], out: str = "position_no") -> DataFrame:
    """ROW_NUMBER() of each row within ``keys`` along ``order_by`` (ascending, nulls last).

    Rows equal in all of ``order_by`` share a range: give a tie-break where one value may hold very many rows.
    """
    order = [F.col(c).asc_nulls_last() for c in order_by]
    placed = in_ranges(df, keys, ascending(order_by))
    local = placed.withColumn("__local", F.row_number().over(Window.partitionBy(*keys, RANGE).orderBy(*order)))
    offsets = F.broadcast(earlier_total(placed, keys, F.lit(1), "__offset"))
    numbered = _match(local, offsets, [*keys, RANGE])
    return numbered.withColumn(out, F.coalesce("__offset", F.lit(0)) + F.col("__local")).drop("__offset", "__local", RANGE)


def every_nth(df: DataFrame, keys: list[str], order_by: list[str], n: int) -> DataFrame:
    """Systematic sampling: the first, (n+1)-th, (2n+1)-th ... row of each key along ``order_by``."""
    numbered = position_within(df, keys, order_by, "__position")
    return numbered.filter((F.col("__position") - 1) % n == 0).drop("__position")


def previous_value(df: DataFrame, keys: list[str], order_by: list[str], value: str, out: str) -> DataFrame:
    """LAG(value) within ``keys`` along ``order_by`` (ascending, nulls last); the first row of a key gets NULL.

    Where a key goes on in a later range, its first row there takes the last value of the range before.
    """
    order = [F.col(c).asc_nulls_last() for c in order_by]
    placed = in_ranges(df, keys, ascending(order_by))
    in_range = Window.partitionBy(*keys, RANGE).orderBy(*order)
    sort_key = F.struct(*ascending(order_by))
    last = placed.groupBy(*keys, RANGE).agg(F.max_by(F.col(value), sort_key).alias("__last"))
    along = Window.partitionBy(*keys).orderBy(RANGE)
    carried = last.select(*keys, RANGE, F.lag("__last").over(along).alias("__carried"), F.row_number().over(along).alias("__nth"))
    carried = carried.filter("__nth > 1").drop("__nth")
    local = placed.withColumns({"__local": F.lag(value).over(in_range), "__first": F.row_number().over(in_range) == 1})
    joined = _match(local, F.broadcast(carried), [*keys, RANGE])
    chosen = F.when(F.col("__first"), F.col("__carried")).otherwise(F.col("__local"))
    return joined.withColumn(out, chosen).drop("__local", "__first", "__carried", RANGE)
