"""Analytical marts: standings, strategy, comparison, enrichment, counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.windows import rank_within
from starmart.schemas import LAST_PODIUM_POSITION, WINNING_POSITION
from starmart.sources.staging import stage

ARROW = " → "


def season_totals(facts: DataFrame, by: list[str], measures: dict[str, Column]) -> DataFrame:
    """Plain partial + final aggregation; the shuffle carries one row per group and task."""
    return facts.groupBy(*by).agg(*[measure.alias(name) for name, measure in measures.items()])


def standings(
    facts: DataFrame,
    season: str,
    entity: str,
    measures: dict[str, Column],
    score: str = "total_points",
    out: str = "championship_rank",
) -> DataFrame:
    """Totals per (season, entity) and the entity's rank in the season.

    The totals are staged: ranking reads them several times, and they are far smaller than
    the facts. To serve one season, filter ``facts`` first: the filter reaches their scan.
    """
    totals = stage(season_totals(facts, [season, entity], measures), "totals")
    return rank_within(totals, [season], score, out)


def ranked_drivers(
    facts: DataFrame, season: str = "year", entity: str = "driver_id", measures: dict[str, Column] | None = None
) -> DataFrame:
    """Season standings of drivers, without names."""
    measures = measures or {
        "total_points": F.sum("points"),
        "wins": F.count_if(F.col("is_winner")),
        "points_finishes": F.count_if(F.col("is_points_finish")),
    }
    return standings(facts, season, entity, measures).select(season, entity, *measures, "championship_rank")


def with_names(ranked: DataFrame, drivers: DataFrame, entity: str = "driver_id", name: str = "driver_name") -> DataFrame:
    """Ranked rows with names from the dimension. An unknown driver keeps its row with a NULL name.

    The name is joined to the ranked totals, not to the facts: the dimension's key is unique,
    so the result is the same and far fewer rows take part. The join is left to Spark, which
    broadcasts the dimension only while it is small.
    """
    first = ranked.columns[: ranked.columns.index(entity) + 1]
    rest = [c for c in ranked.columns if c not in first]
    return ranked.join(drivers.select(entity, name), entity, "left").select(*first, name, *rest)


def driver_standings(
    facts: DataFrame,
    drivers: DataFrame,
    season: str = "year",
    entity: str = "driver_id",
    name: str = "driver_name",
    measures: dict[str, Column] | None = None,
) -> DataFrame:
    """Season standings of drivers, with names."""
    return with_names(ranked_drivers(facts, season, entity, measures), drivers, entity, name)


def team_standings(
    facts: DataFrame, season: str = "year", entity: str = "team", measures: dict[str, Column] | None = None
) -> DataFrame:
    measures = measures or {"total_points": F.sum("points"), "wins": F.count_if(F.col("is_winner"))}
    return standings(facts, season, entity, measures).select(season, entity, *measures, "championship_rank")


def pit_strategy(
    stops: DataFrame,
    by: list[str] = ["year", "gp_name", "driver_id"],
    duration: str = "pit_duration_sec",
    text: str = "compound",
    order_by: list[str] = ["lap_number"],
    separator: str = ARROW,
) -> DataFrame:
    """Stops, mean and best duration, and the ordered text sequence per group.

    NULL texts are skipped and a group without any gives NULL. A group's sequence is one
    string of the result, so a group can never hold more than fits one row; the stop key
    (race, driver, lap number as SMALLINT) bounds it at 32,767 stops.
    """
    kind = stops.schema[duration].dataType
    mean = F.avg(duration)
    if isinstance(kind, T.DecimalType):
        mean = mean.cast(T.DecimalType(min(38, kind.precision + 4), kind.scale + 4))
    # the ordered form of listagg exists in SQL only
    order = ", ".join(f"`{c}` ASC NULLS LAST" for c in order_by)
    quoted = separator.replace("\\", "\\\\").replace("'", "\\'")
    sequence = F.expr(f"listagg(`{text}`, '{quoted}') WITHIN GROUP (ORDER BY {order})")
    return stops.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_stops"),
        mean.alias("avg_pit_duration_sec"),
        F.min(duration).alias("fastest_pit_sec"),
        sequence.alias("tyre_strategy"),
    )


def compare_entities(
    facts: DataFrame,
    entity: str = "driver_id",
    position: str = "position",
    points: str = "points",
    among: list | None = None,
    podium: int = LAST_PODIUM_POSITION,
) -> DataFrame:
    """Mean position, points, wins and podiums per entity, optionally of the named entities only."""
    rows = facts if among is None else facts.filter(F.col(entity).isin(among))
    return rows.groupBy(entity).agg(
        F.avg(position).alias("avg_position"),
        F.coalesce(F.sum(points), F.lit(0)).alias("total_points"),
        F.count_if(F.col(position) == WINNING_POSITION).alias("wins"),
        F.count_if(F.col(position) <= podium).alias("podiums"),
    )


def compare_series(
    facts: DataFrame,
    among: list,
    entity: str = "driver_id",
    unit: str = "round",
    columns: list[str] = ["round", "gp_name", "driver_id", "position", "points"],
) -> DataFrame:
    """The compared entities' rows in order of ``unit``, one row per unit and entity."""
    rows = facts.filter(F.col(entity).isin(among)).select(*columns)
    return rows.orderBy(F.col(unit).asc_nulls_last(), F.col(entity).asc_nulls_last())


def compare_series_wide(
    facts: DataFrame, among: list, entity: str = "driver_id", unit: str = "round", value: str = "points"
) -> DataFrame:
    """One row per unit, one column per compared entity."""
    rows = facts.filter(F.col(entity).isin(among))
    return rows.groupBy(unit).pivot(entity, among).agg(F.sum(value))


def star_join(fact: DataFrame, dims: list[tuple[DataFrame, dict[str, str], list[str]]]) -> DataFrame:
    """Left-join dimensions to a fact: (dimension, {fact column: dimension column}, columns to add).

    Each dimension is projected to what is asked for. No broadcast is forced: Spark does so
    for a dimension whose measured size is small, and splits skewed keys of a large one.
    """
    joined = fact
    for dim, on, columns in dims:
        keys = {d: f"__k_{d}" for d in on.values()}
        side = dim.select(*[F.col(d).alias(k) for d, k in keys.items()], *columns)
        condition = reduce(lambda a, b: a & b, [F.col(f) == F.col(keys[d]) for f, d in on.items()])
        joined = joined.join(side, condition, "left").drop(*keys.values())
    return joined


def table_counts(spark: SparkSession, counts: dict[str, str]) -> DataFrame:
    """Row counts of several tables or views in one row: output name -> table."""
    return spark.sql("SELECT " + ", ".join(f"(SELECT count(*) FROM {t}) AS {name}" for name, t in counts.items()))
